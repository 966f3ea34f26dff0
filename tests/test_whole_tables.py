"""Queries over rows that the given tables lack at the smallest size, against brute force."""

from loomwright.plans import catalogue


def test_next_fit_batches_takes_all_orders(spark, tmp_path):
    orders = [(k, k * 7 % 900) for k in range(1, 400)]
    lines = [(k,) for k, _ in orders for _ in range(k * 5 % 23)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    want, held, batch = {}, 0, 0
    for k, _ in orders:
        w = max(1, k * 5 % 23)
        if held and held + w > 48:
            held, batch = 0, batch + 1
        held += w
        want[k] = (w, batch)
    got = catalogue.next_fit_batches(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {r.o_orderkey: (r.weight, r.batch) for r in got} == want


def test_slug_names_reads_whole_texts(spark, tmp_path):
    rows = [(1, "?" * 80 + "name after signs"), (2, "a" + " " * 70 + "b"), (3, "." * 60), (4, "plain")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.name for r in catalogue.slug_names(spark, str(tmp_path)).collect()} == {1: "name_after_signs", 2: "a_b", 3: "diagram", 4: "plain"}
