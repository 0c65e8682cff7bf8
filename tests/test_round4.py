"""Derived tables and jobs that grow with their input."""

from pyspark.sql import functions as F

from tables import SF_SMALL
from tessera.sources import catalogue, lenses, objects


def _under_range_exchanges(df) -> list[str]:
    """What each range exchange of the plan reads, one text per exchange."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")

    def depth(s):
        return len(s) - len(s.lstrip(" :+-"))
    found = []
    for i, line in enumerate(lines):
        if "Exchange rangepartitioning" in line:
            below = []
            for s in lines[i + 1:]:
                if depth(s) <= depth(line):
                    break
                below.append(s)
            found.append("\n".join([line, *below]))
    return found


def test_stored_documents_are_ordered_before_they_are_rendered(spark):
    for df, made in ((catalogue.render_dataset(spark, SF_SMALL), "to_json"), (lenses.render_requests(spark, SF_SMALL), "array_join")):
        below = _under_range_exchanges(df)
        assert below and made in df._jdf.queryExecution().executedPlan().toString().lower().replace("structstojson", "to_json")
        assert not any(x in b.lower() for b in below for x in (made, "structstojson", "metadata#", "order_json"))


def test_stored_documents_lie_in_order(spark):
    d = catalogue.dataset(spark, SF_SMALL)
    assert d.count() == catalogue.scene_base(spark, SF_SMALL).count()
    rows = d.select(F.input_file_name().alias("f"), "dataset_type_ref", "t_lo").collect()
    at = {}
    for r in rows:
        key = (r.dataset_type_ref, r.t_lo)
        assert at.get(r.f, key) <= key
        at[r.f] = key


def test_objects_named_by_rows_are_read_without_a_listing(spark, tmp_dir):
    from tessera.operators import objects as obj
    files = spark.createDataFrame([(f"a/{i}/x.yaml", f"k: {i}") for i in range(5)] + [("a/0/x.yaml", "k: 0"), (None, "n")], "path string, body string")
    assert obj.write_objects(files.where("path IS NOT NULL"), tmp_dir + "/").where("NOT ok").count() == 0
    asked = files.select("path").unionByName(spark.createDataFrame([("a/9/x.yaml",), ("a",)], "path string"))
    got = objects.read_paths(asked, tmp_dir + "/")
    assert sorted((r.path, r.length, bytes(r.content)) for r in got.collect()) == [(f"a/{i}/x.yaml", 4, f"k: {i}".encode()) for i in range(5)]
    assert {(r.length, r.content) for r in objects.read_paths(asked, tmp_dir + "/", content=False).collect()} == {(4, None)}


def test_rewritten_documents_are_not_listed(spark):
    from tessera.plans.registry import load_all
    for name in ("s13_document_rewrite", "x5_copy_edit_chain"):
        df = load_all()[name].fn(spark, SF_SMALL)
        assert "binaryFile" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.where("NOT ok").count() == 0 and df.count() > 0


def test_projected_orders_are_validated_once(spark, monkeypatch):
    from tessera.operators import orders as ordering
    from tessera.plans import get_work
    from tessera.plans.registry import load_all
    calls, real = [], ordering.validate_orders

    def counted(*a, **k):
        calls.append(1)
        return real(*a, **k)
    monkeypatch.setattr(ordering, "validate_orders", counted)
    monkeypatch.setattr(get_work, "validate_orders", counted)
    df = load_all()["p9_projected_orders"].fn(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(calls) == 1 and "from_json" not in plan and "jsontostructs" not in plan.lower()
    assert df.count() == spark.read.parquet(SF_SMALL + "/orders.parquet").count()


def test_composites_are_named_before_they_are_handed_out(spark):
    from tessera.plans.do_work import order_composites
    cells = spark.createDataFrame([(o, 3, -4, 7) for o in range(5)] + [(9, 3, -4, 8)], "order_id long, tile_x int, tile_y int, id long")
    scenes = spark.sql("SELECT id, TIMESTAMP_NTZ '1996-02-10 00:00:00' AS t, 132.0D AS lon FROM VALUES (7L), (8L) AS v(id)")
    pixels = spark.createDataFrame([(7, 0, 0, 1000.0, 2.0, 3.0, 0), (8, 0, 0, 5000.0, 2.0, 3.0, 0)],
                                   "id long, px int, py int, red double, green double, blue double, qa int")
    df = order_composites(cells, scenes, pixels)
    plan = df._jdf.queryExecution().executedPlan().toString().lower()
    assert "format_string" not in plan and "round(" not in plan
    got = {(r.order_id, r.red, r.n_days) for r in df.collect()}
    assert got == {(o, -0.1725, 1) for o in range(5)} | {(9, -0.0625, 1)}
    assert df.select("name").distinct().count() == 1
