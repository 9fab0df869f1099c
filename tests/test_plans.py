"""Plans: what reaches the scan, what is shuffled, what is combined before a shuffle."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from otelier.functions.expressions import place_in, search_steps, sorted_table
from otelier.functions.series import _bounds, with_previous
from otelier.operators.flatten import flatten_logs, flatten_spans
from otelier.operators.relational import count_rows, dedup_rows, dedup_subset, filter_id, filter_valid
from otelier.operators.packets import deflatten
from otelier.operators.traces import basic_spans, span_parent
from otelier.plans import fixtures
from otelier.sources.flat import read_flat, read_signal, write_flat


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = write_flat(fixtures.spans(spark, sf), "spans", str(tmp_path_factory.mktemp("flat")))
    return read_flat(spark, "spans", path)


def test_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(filter_id(filter_valid(stored), "trace_id", "00" * 15 + "02").select("name", "status.code"))
    read = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert read == "struct<trace_id:binary,name:string,status:struct<code:string>,is_valid:boolean>"
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "EqualTo(trace_id" in pushed and "EqualTo(is_valid,true)" in pushed


def test_view_reads_only_what_a_query_uses(stored):
    plan = plan_of(count_rows(basic_spans(stored), "kind", "status_code"))
    assert plan.split("ReadSchema: ")[1].splitlines()[0].startswith("struct<kind:string,status:struct<code:string>>")
    assert "map_from_entries" not in plan


def test_flattening_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("{}",)], "value string").write.text(path)
    for signal in ("logs", "spans", "metrics", "profiles"):
        assert "Exchange" not in plan_of(read_signal(spark, signal, "raw", path, equal_lines=False)), signal
        # telling equal lines of a file apart takes one
        assert plan_of(read_signal(spark, signal, "raw", path)).split("== Initial Plan ==")[-1].count("Exchange") == 1


def test_packets_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("{}",)], "value string").write.text(path)
    for signal in ("logs", "spans", "metrics"):
        assert plan_of(read_signal(spark, signal, "raw", path)).count("from_json(StructField(resource") == 1
    # attribute values that hold JSON text are parsed too, hence the pattern
    assert plan_of(read_signal(spark, "profiles", "raw", path)).count("from_json(StructField(resource") == 1


def test_derived_packets_use_one_shuffle(spark, sf):
    plan = plan_of(flatten_logs(fixtures.log_packets(spark, sf)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Window" not in plan_of(flatten_spans(fixtures.span_packets(spark, sf)))


def test_hourly_values_aggregate_in_hash_maps(spark, sf):
    assert "SortAggregate" not in plan_of(fixtures.hourly(spark, sf))


def test_copies_are_combined_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("name"), F.lit(1).alias("sum_int"))
    plan = plan_of(dedup_subset(df))
    assert plan.count("WindowGroupLimit") == 2
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    assert plan_of(dedup_rows(df)).split("Exchange hashpartitioning", 1)[1].count("HashAggregate") >= 1


def test_series_are_cut_into_ranges(spark):
    """A series that holds all points, within one second, is many tasks; the points are exchanged, sorted and windowed once."""
    hot = F.lit("k").alias("k")
    df = spark.range(100_000).select(hot, F.col("id").alias("t"), F.col("id").alias("v")).repartition(4)
    found = with_previous(df, ["k"], "t", ["v"], 16)
    assert found.where("_previous.t = t - 1 AND _previous.v = v - 1").count() == 99_999
    plan = plan_of(found)
    initial = plan.split("== Initial Plan ==")[-1]
    # over all points: one exchange by range, read by the window and by the last points of the ranges
    assert initial.count("Exchange hashpartitioning(_range") <= 2 and "RangePartitioning" not in plan
    sizes = [r["n"] for r in found.groupBy(F.floor(F.col("t") / 6250).alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 16
    bounds = _bounds(df, [F.col("k")], "t", 16)
    cut = sorted(t for _, t in bounds)
    assert len(cut) == 15 and max(b - a for a, b in zip([0, *cut], [*cut, 100_000])) < 3 * 100_000 / 16


def test_parents_are_found_without_sorted_aggregation(stored):
    plan = plan_of(span_parent(stored.select("trace_id", "span_id", "parent_span_id", "name"), ["name"]))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_packets_are_rebuilt_on_one_exchange(stored):
    plan = plan_of(deflatten(stored, "spans"))
    assert plan.count("Exchange ") == 1 and "InMemoryTableScan" not in plan


def test_derived_packets_are_rebuilt_without_sorts_of_whole_rows(spark, sf):
    """What is exchanged are the fields a span is built from, once; the spans themselves are neither exchanged nor sorted."""
    plan = plan_of(entry.queries()["deflatten"](spark, sf))
    above, below = plan.split("REPARTITION_BY_NUM", 1)
    assert above.count("Exchange ") == 1 and "Sort [" not in above and "Window" not in above
    assert above.count("ObjectHashAggregate") == 4
    assert "rpc.method" not in below and "kvlist_value" not in below
    # where packets are written, adaptive execution may still lower the number of tasks, and so of files
    assert "REPARTITION_BY_NUM" not in plan_of(fixtures.span_packets(spark, sf))


@pytest.mark.parametrize("name", ["attr_map_nested", "attr_strindex_nested"])
def test_nested_values_are_rendered_in_many_tasks(spark, sf, name):
    """The customers are one small file; their values take long to render."""
    per_task = [r["count"] for r in entry.queries()[name](spark, sf).groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 8 and max(per_task) <= 2 * sum(per_task) / 8


def test_dispatch_parses_packets_once(spark, sf):
    """Raw rows are counted while they are written as flat ones."""
    found = entry.queries()["src_dispatch"](spark, sf)
    assert "from_json(StructField(resource" not in plan_of(found)
    assert {(r["signal"], r["layout"]) for r in found.collect()} == {(s, y) for s in fixtures.PACKETS for y in ("raw", "flat")}


def test_ids_of_packets_are_not_broadcast(spark, sf):
    """There is one per packet, and the driver would hold all of them."""
    found = entry.queries()["stream_lineage"](spark, sf)
    assert "Broadcast" not in plan_of(found)
    found.collect()
    assert "Broadcast" not in plan_of(found)


def test_profiles_are_rebuilt_from_one_exchange_without_linear_search(spark, sf):
    """What is made of the rows shares their exchange, so the rows are computed once."""
    found = entry.queries()["deflatten_profiles"](spark, sf)
    found.collect()
    plan = plan_of(found).split("== Initial Plan ==")[0]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(batch_UUID" in line]
    assert sum("ReusedExchange" not in line for line in exchanges) == 1
    assert "array_position(" not in plan and "array_distinct(transform(locations" not in plan


def test_places_in_sorted_tables(spark):
    """Equal structs are one entry; every entry is found, whatever the size of the table."""
    for n in (0, 1, 2, 3, 7, 8, 100):
        entries = [(i % 10, None if i % 3 == 0 else f"t{i // 2}") for i in range(n)]
        df = spark.createDataFrame([([*entries, *entries[::-1], None],)], "items array<struct<a int, b string>>")
        df = df.withColumn("t", sorted_table(F.col("items"))).withColumn("steps", search_steps(F.size("t")))
        table, places = df.select("t", F.transform("items", lambda x: place_in(F.col("t"), F.col("steps"), x))).first()
        assert len(table) == len(set(entries)) and {tuple(x) for x in table} == set(entries)
        assert [tuple(table[i]) for i in places[:-1]] == [*entries, *entries[::-1]] and places[-1] is None
    texts = spark.createDataFrame([(["", "a", "b", None], None)], "t array<string>, none array<string>")
    steps = search_steps(F.size("t"))
    assert texts.select(F.transform("t", lambda x: place_in(F.col("t"), steps, x)), place_in(F.col("none"), search_steps(F.size("none")), F.lit("a"))).first()[:] == (
        [0, 1, 2, None], None)
