from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import ring
from broadsheet.operators import activity as ac, currency as cur, facets as fc, maintain as mt, sketches, versions
from broadsheet.sources.manifest import MANIFEST_COLUMNS
from broadsheet.streaming import state
from broadsheet.streaming.ingest import ingest_manifests, issues_from

from tests.test_ingest import HEADER, ISSUE, row


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, body string, v int")


def contents(df):
    return {r.id: r.body for r in df.collect()}


def test_upsert_is_idempotent_and_last_wins(spark):
    index = frame(spark, [("a", "old", 0), ("b", "old", 0)])
    batch = frame(spark, [("b", "new1", 1), ("b", "new2", 2), ("c", "new", 1), (None, "lost", 9)])
    once = mt.upsert(index, batch, "v")
    assert contents(once) == {"a": "old", "b": "new2", "c": "new"}
    assert sorted(map(tuple, mt.upsert(once, batch, "v").collect())) == sorted(map(tuple, once.collect()))
    (lost,) = mt.without_id(batch).collect()
    assert lost.reason == "NO_ID"


def test_upsert_with_one_very_hot_id(spark):
    hot = spark.range(50_000).select(F.lit("x").alias("id"), F.col("id").cast("string").alias("body"), F.col("id").cast("int").alias("v"))
    assert contents(mt.upsert(frame(spark, [("x", "old", 0)]), hot, "v")) == {"x": "49999"}


def test_delete_keeps_rows_with_unknown_result(spark):
    index = frame(spark, [("a", "x", 1), ("b", "y", None)])
    assert contents(mt.delete_by_query(index, F.col("v") == 1)) == {"b": "y"}
    assert contents(mt.delete_by_query(index, F.lit(True))) == {}


def test_copies_keep_the_lowest_id(spark):
    df = frame(spark, [("b", "same", 1), ("a", "same", 2), ("c", "other", 1), ("d", None, 1), ("e", None, 1)])
    assert contents(mt.signature_dedupe(df, ["body"])) == {"a": "same", "c": "other", "d": None}


def test_log_of_batches_replays_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    mt.append_batch(frame(spark, [("a", "1", 0), ("b", "1", 0)]), path, 0)
    for _ in range(2):
        mt.append_batch(frame(spark, [("b", "2", 0), ("c", "2", 0)]), path, 1)
    log = mt.read_log(spark, path)
    assert log.count() == 4 and contents(mt.current_articles(log)) == {"a": "1", "b": "2", "c": "2"}


def test_versions_become_visible_when_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    assert mt.latest_version(spark, path) is None
    mt.commit(frame(spark, [("a", "1", 0)]), path, 1)
    mt.commit(mt.latest_version(spark, path)[1].unionByName(frame(spark, [("b", "2", 0)])), path, 2)
    (tmp_path / "t" / "v=0000000003").mkdir()
    version, df = mt.latest_version(spark, path)
    assert version == 2 and contents(df) == {"a": "1", "b": "2"}


def test_streaming_ingest_equals_batch(spark, tmp_path):
    manifests, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))
    (tmp_path / "in").mkdir()
    archive = spark.createDataFrame(
        [("1", ISSUE), ("2", ISSUE.replace("a1", "b1").replace("a2", "b2")), ("3", ISSUE.replace("five", "six"))],
        "domid string, xml string",
    )

    def arrive(name, *lines):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        ingest_manifests(spark, manifests, issues_from(archive), table, marks, id_prefix="p-").awaitTermination()
        return {r.id: r.content for r in mt.current_articles(mt.read_log(spark, table)).collect()}

    first = arrive("one.csv", HEADER, row("1"))
    assert sorted(first) == ["p-a1", "p-a2"] and first["p-a1"].endswith("five")
    second = arrive("two.csv", row("2"), row("3"), row("2")[:-1])
    assert sorted(second) == ["p-a1", "p-a2", "p-b1", "p-b2"] and second["p-a1"].endswith("six")
    assert arrive("three.csv", HEADER) == second


def test_facet_sums_equal_hits(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("b"))
    assert sum(r.n for r in fc.facet_field(df, "a").collect()) == 1000
    assert sum(r.n for r in fc.facet_fields(df, ["b"]).collect()) == df.where("b is not null").count()
    pivot = fc.facet_pivot(df, "a", "b").collect()
    assert sum(r.n for r in pivot if r.level == 1) == 1000
    assert sum(r.n for r in pivot if r.level == 2) == df.where("b is not null").count()


def test_facet_order_mincount_and_arrays(spark):
    df = spark.createDataFrame([(["x", "y"],), (["y"],), (["z", "y", "x"],), (None,)], "t array<string>")
    assert [tuple(r) for r in fc.facet_field(df, "t").collect()] == [("y", 3), ("x", 2), ("z", 1)]
    assert [tuple(r) for r in fc.facet_field(df, "t", mincount=2, limit=1).collect()] == [("y", 3)]


def test_numeric_range_end_rounds_up(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 2.9, 3, 9, 11.9, 12, 50)], "v double")
    got = {(r.bucket, r.lower): r.n for r in fc.facet_range(df, "v", 0, 10, 3, ["before", "after"]).collect()}
    assert got == {("before", None): 1, ("range", 0.0): 2, ("range", 3.0): 1, ("range", 9.0): 2, ("after", None): 2}
    with pytest.raises(ValueError):
        fc.facet_range(df, "v", 0, 10, 0)


@pytest.mark.parametrize("unit, gap, start, end", [("MONTH", 1, "2020-01-31", "2021-01-31"), ("YEAR", 2, "2016-02-29", "2023-02-28"), ("HOUR", 36, "2020-03-01", "2020-06-01")])
def test_date_ranges_match_brute_force(spark, unit, gap, start, end):
    ts = spark.range(0, 3000).select(F.timestamp_add("HOUR", (F.col("id") * 29).cast("int"), F.lit("2015-06-01").cast("timestamp")).alias("ts"))
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    got = {(r.bucket, r.lower): r.n for r in fc.facet_range_dates(ts, "ts", lo, hi, gap, unit, ["before", "after"]).collect()}
    edges = [r.b for r in spark.range(200).select(F.timestamp_add(unit, (F.col("id") * gap).cast("int"), lo).alias("b")).collect()]
    last = spark.range(1).select(hi.alias("h")).first().h
    stop = next(e for e in edges if e >= last)
    want: dict = {}
    for (v,) in ts.collect():
        if v < edges[0]:
            key = ("before", None)
        elif v >= stop:
            key = ("after", None)
        else:
            key = ("range", max(e for e in edges if e <= v))
        want[key] = want.get(key, 0) + 1
    assert got == {("before", None): 0, ("after", None): 0} | want


def test_currency_ways(spark):
    rates = spark.createDataFrame([("USD", "EUR", 0.5), ("USD", "GBP", 0.25), ("EUR", "GBP", 0.6), ("USD", "JPY", 100.0)], "`from` string, `to` string, rate double")
    df = spark.createDataFrame([(1.0, c) for c in ("USD", "EUR", "GBP", "JPY", "XXX")], "amount double, code string")
    got = {r.code: r.converted for r in cur.convert(df, "amount", "code", "GBP", rates).collect()}
    assert got == {"USD": 0.25, "EUR": 0.6, "GBP": 1.0, "JPY": pytest.approx(0.0025), "XXX": None}


def test_activity(spark):
    searches = spark.createDataFrame([(i, 1 if i < 8 else 2, i, '{"q":"%s"}' % ("a" if i % 3 else "b")) for i in range(10)], "search_id int, user_id int, created_at int, query_params string")
    users = spark.createDataFrame([(1, False, 4), (2, True, 1), (3, True, 0)], "user_id int, guest boolean, sign_in_count int")
    got = {r.guest: (r.users, r.searches, r.sign_ins) for r in ac.activity_by_account(searches, users).collect()}
    assert got == {False: (1, 8, 4), True: (2, 2, 1)}
    recent = [(r.user_id, r.search_id) for r in ac.recent_searches(searches, 2).orderBy("user_id", "rank").collect()]
    assert recent == [(1, 7), (1, 6), (2, 9), (2, 8)]
    assert [tuple(r) for r in ac.popular_params(searches, "q", 1).collect()] == [("a", 6)]


def test_manifest_columns_are_the_file_header():
    assert ",".join(f'"{c}"' for c in MANIFEST_COLUMNS) == HEADER


def test_ranges_with_decimal_gaps_and_rows_beside_them(spark):
    df = spark.createDataFrame([(0.3,), (0.1,), (0.7,), (-1.0,), (2.0,), (None,)], "v double")
    got = {(r.bucket, r.lower): r.n for r in fc.facet_range(df, "v", 0, 1, 0.1, ["all"], mincount=0).collect()}
    assert {k[1]: n for k, n in got.items() if k[0] == "range" and n} == {0.1: 1, 0.3: 1, 0.7: 1}
    assert len([k for k in got if k[0] == "range"]) == 10
    assert (got["before", None], got["between", None], got["after", None]) == (1, 3, 1)
    assert {r.bucket for r in fc.facet_range(df, "v", 0, 1, 0.1, ["none", "all"]).collect()} == {"range"}
    with pytest.raises(ValueError):
        fc.facet_range(df, "v", 0, 1, 0.1, ["beyond"])


def test_shared_folder_is_required_on_a_cluster():
    from broadsheet.session import shared_dir

    class Conf(dict):
        pass

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        shared_dir(Cluster(), "x")
    Cluster.conf["spark.checkpoint.dir"] = "hdfs://shared"
    assert shared_dir(Cluster(), "x").startswith("hdfs://shared/broadsheet-x-")


# Published results of the hash with seed 0.
VECTORS = {"": 0, "test": 0xBA6BD213, "hello": 0x248BFA47, "hello, world": 0x149BBB7F, "abc": 0xB3DD93FA,
           "The quick brown fox jumps over the lazy dog": 0x2E4FF723}


def murmur(data: bytes) -> int:
    h, mask = 0, 0xFFFFFFFF
    rot = lambda x, r: (x << r | x >> (32 - r)) & mask
    scr = lambda k: rot(k * ring.C1 & mask, 15) * ring.C2 & mask
    for i in range(0, len(data) // 4 * 4, 4):
        h = (rot(h ^ scr(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + ring.ADD) & mask
    h ^= scr(int.from_bytes(data[len(data) // 4 * 4 :], "little")) ^ len(data)
    h = (h ^ h >> 16) * ring.MIX1 & mask
    h = (h ^ h >> 13) * ring.MIX2 & mask
    return h ^ h >> 16


def signed(x: int) -> int:
    return x - (1 << 32) if x >> 31 else x


def test_ring_hash(spark):
    assert all(murmur(k.encode()) == v for k, v in VECTORS.items())
    texts = [*VECTORS, "é", "a€b", "😀😀", "x" * 1001, *(f"art-{i}" for i in range(300)), "a!b", "!b", "a!", "news!x-1", "news!x-2", "a!b!c"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "id string")
    got = {r.id: (r.h, r.p, r.s) for r in df.select("id", ring.murmur(F.col("id")).alias("h"), ring.ring_hash(F.col("id")).alias("p"), ring.ring_shard(F.col("id"), 7).alias("s")).collect()}
    ranges = ring.ring_ranges(7)
    assert ranges[0][0] == -(1 << 31) and ranges[-1][1] == (1 << 31) - 1 and all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(b - a for a, b in ranges) - min(b - a for a, b in ranges) <= 1 << 16
    for t in texts:
        h, p, s = got[t]
        assert h == signed(murmur(t.encode()))
        at = t.find("!")
        if 0 < at < len(t) - 1:
            assert p & 0xFFFFFFFF == murmur(t[:at].encode()) & 0xFFFF0000 | murmur(t[at + 1 :].encode()) & 0xFFFF
        else:
            assert p == h
        assert ranges[s][0] <= p <= ranges[s][1]
    assert got[None] == (None, None, None) and got["news!x-1"][2] == got["news!x-2"][2]
    with pytest.raises(ValueError):
        ring.ring_shard(F.col("id"), 0)


def test_versions_and_newer_batches(spark, tmp_path):
    path = f"{tmp_path}/log"
    rows = lambda *x: spark.createDataFrame(x, "id int, v string")
    held = lambda: {(r.id, r.v) for r in versions.committed(spark, path).collect()}
    assert versions.newest_version(spark, path) is None and versions.committed(spark, path) is None and versions.compact(spark, path) is None
    mt.append_batch(rows((1, "a"), (2, "a")), path, 0)
    mt.append_batch(rows((2, "b"), (3, "b")), path, 1)
    assert held() == {(1, "a"), (2, "b"), (3, "b")}
    assert versions.compact(spark, path)[0::2] == (1, 1) and held() == {(1, "a"), (2, "b"), (3, "b")}
    assert versions.compact(spark, path) is None
    mt.append_batch(rows((3, "c"), (4, "c")), path, 2)
    assert held() == {(1, "a"), (2, "b"), (3, "c"), (4, "c")}
    # The version stands for the batches up to its last one, which are not read again.
    shutil.rmtree(f"{path}/batch_id=0")
    assert held() == {(1, "a"), (2, "b"), (3, "c"), (4, "c")}
    assert "batch_id=1" not in " ".join(versions.committed(spark, path).inputFiles())
    second = versions.compact(spark, path)
    assert second[0::2] == (2, 2) and held() == {(1, "a"), (2, "b"), (3, "c"), (4, "c")}
    # The log itself can still be read as before.
    assert mt.read_log(spark, path).count() == 4


def test_of_two_writers_one_wins(spark, tmp_path):
    path = f"{tmp_path}/log"
    mt.append_batch(spark.createDataFrame([(1, "a")], "id int, v string"), path, 0)
    versions.publish(spark, path, versions.Version(1, "_data/first", 0))
    with pytest.raises(versions.VersionConflict):
        versions.publish(spark, path, versions.Version(1, "_data/second", 0))
    assert versions.newest_version(spark, path).folder == "_data/first"


def test_sketches_stay_near_exact_counts(spark, tmp_path):
    rows = [(i, f"v{i % 3000}" if i % 4 else None, float(i % 977), "x" if i % 2 else None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id int, name string, size double, half string")
    for batch in range(4):
        part = df.where(F.col("id") % 4 == batch)
        sketches.write_sketches(part, str(tmp_path / "s"), batch, ["name", "size", "half"], group=F.col("id") % 5)
    sketches.write_sketches(df.where("id % 4 = 3"), str(tmp_path / "s"), 3, ["name", "size", "half"], group=F.col("id") % 5)  # repeated
    stored = sketches.read_sketches(spark, str(tmp_path / "s"))
    told = {r.field: r for r in sketches.sketch_stats(stored).collect()}
    assert {f: (r.rows, r.present) for f, r in told.items()} == {"name": (20_000, 15_000), "size": (20_000, 20_000), "half": (20_000, 10_000)}
    exact = len({r[1] for r in rows if r[1]})
    assert abs(told["name"].distinct_values - exact) <= 0.07 * exact and told["half"].distinct_values == 1
    assert told["name"].quantiles is None
    for q, x in zip((0.25, 0.5, 0.75), told["size"].quantiles):
        assert abs(x - 977 * q) <= 977 * 0.03
    over = sketches.sketch_overlap(stored, ["name", "half"]).first()
    both = sum(r[1] is not None and r[3] is not None for r in rows)
    assert (over.a, over.b) == ("half", "name")
    assert abs(over.both - both) <= 0.1 * both and abs(over.only_a - (10_000 - both)) <= 0.1 * 10_000
    plan = sketches.sketch_stats(stored)._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) in plan


def test_stream_keeps_the_first_of_each_key(spark, tmp_path):
    from datetime import datetime, timedelta

    start = datetime(2020, 1, 1)
    kind = "id int, v string, arrived timestamp"
    drops = [
        [(1, "a", start), (1, "a2", start), (2, "b", start + timedelta(hours=1)), (None, "x", start), (5, "x", None)],
        [(2, "b2", start + timedelta(hours=2)), (3, "c", start + timedelta(hours=50))],
        [(4, "late", start + timedelta(hours=2)), (3, "c2", start + timedelta(hours=50)), (6, "d", start + timedelta(hours=49))],
    ]
    for i, drop in enumerate(drops):
        spark.createDataFrame(drop, kind).coalesce(1).write.parquet(f"{tmp_path}/in/drop={i}")
        rows = spark.readStream.schema(kind).parquet(f"{tmp_path}/in/*")
        state.append_stream(state.once_per_key(rows, "id", "arrived", "10 hours"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = {(r.id, r.v[0]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(1, "a"), (2, "b"), (3, "c"), (6, "d")}


def test_one_parse_for_all_results(spark, tmp_path):
    from broadsheet.plans import bindings as bind, jobs
    from tests.test_registered import DATA, plan_of

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    lines, xml = bind.manifest_lines(docs), bind.issue_xml(docs)
    job = jobs.index_once(lines, xml, f"{tmp_path}/parsed", "p-")
    plain = jobs.index_articles(lines, xml, "p-")
    for one, other in ((job.articles, plain.articles), (job.rejects, plain.rejects), (job.status, plain.status)):
        assert "from_xml" not in plan_of(one) and f"{tmp_path}/parsed" in plan_of(one)
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
