"""Texts that begin like licences again and again, and texts that are many licences."""

import time

from llm import licences


def seconds(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    rows = {(r.license_id, r.scope): r.n_units for r in licences.scan(df).collect()}
    return time.perf_counter() - began, rows


def test_work_grows_with_the_text(spark):
    seconds(spark, "warm " * 1000)
    mit = licences.TEXTS["MIT"]
    cases = {
        "preamble": "preamble x\n" * 4000,
        "granted": "permission is hereby granted\n" * 4000,
        "granted free": "permission is hereby granted free of charge to any person\n" * 4000,
        "two lines": "redistribution and use in source\nand binary forms with or without\n" * 2000,
        "general": "preamble the gnu general public\n" * 4000,
        "many": (mit + "\n\n") * 1000,
    }
    for name, text in cases.items():
        plain = "plain words that no licence begins with\n" * (len(text) // 40)
        usual, _ = seconds(spark, plain)
        took, rows = seconds(spark, text)
        assert took < 3 * usual + 2, (name, took, usual)
        assert rows.get(("MIT", "passage"), 0) == (1000 if name == "many" else 0)


def test_texts_that_hold_the_beginning_of_others(spark):
    mit, isc = licences.TEXTS["MIT"], licences.TEXTS["ISC"]
    wrapped = mit.replace(" ", "\n")
    rows = [
        (1, "x\n" + wrapped), (2, "x\nPermission is hereby granted\n" + mit), (3, mit[:100] + "\n" + mit), (4, "a " + mit), (5, mit + "\n" + isc + "\n" + mit), (6, mit + " and"), (7, mit + "s"),
        (8, "x\n" + "\n".join(mit[i : i + 30] for i in range(0, len(mit), 30))),
    ]
    got = {(r.doc_id, r.license_id, r.n_units) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.scope == "passage"}
    assert got == {(1, "MIT", 1), (2, "MIT", 1), (3, "MIT", 1), (5, "MIT", 2), (5, "ISC", 1), (6, "MIT", 1), (7, "MIT", 1)}  # a full stop ends a word
