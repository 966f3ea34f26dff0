"""Whole licence texts: with and without title, alone and inside longer documents."""

from llm import licences


def test_whole_texts(spark):
    file = lambda name: (licences.FILES / f"{name}.txt").read_text()
    mit, bsd, gpl = licences.TEXTS["MIT"], file("BSD-3-Clause"), file("GPL-3.0")
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Someone\n\n" + mit), (2, "The MIT License (MIT)\nCopyright (c) 2020 Someone\n" + mit.replace("\n\n", "\n")),
        (3, "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + bsd), (4, bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")), (5, gpl),
        (6, "A project\n\nwith code of others:\n\n" + mit + "\n\nand\n\n" + bsd + "\n\n" + mit + "\nThe end"), (7, "some words\n" + gpl[: gpl.index("How to Apply")]), (8, mit[:-10]), (9, "x\n" + bsd.replace("provided that", "if")), (10, "x\n" + mit[:-1] + "s"),
    ]
    rows += [(100 + i, file(name)) for i, name in enumerate(licences.TERMS)]
    got = {(r.doc_id, r.license_id, r.scope, r.n_units) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.scope in ("document", "passage")}
    whole = {(r[0], r[1], r[3]) for r in got if r[2] == "document"}
    assert whole == {(1, "MIT", 1), (2, "MIT", 1), (3, "BSD-3-Clause", 1), (4, "BSD-3-Clause", 1), (5, "GPL-3.0", 1)} | {(100 + i, name, 1) for i, name in enumerate(licences.TERMS)}
    inside = {(r[0], r[1], r[3]) for r in got if r[2] == "passage" and r[0] in (1, 6, 7, 8, 9, 10)}
    assert inside == {(1, "MIT", 1), (6, "MIT", 2), (6, "BSD-3-Clause", 1), (7, "GPL-3.0", 1)}
