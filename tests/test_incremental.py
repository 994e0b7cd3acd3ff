"""Tables in parts and gold tables that follow their documents."""

import os

import pytest
from pyspark.sql import functions as F

from checks.fixtures import Fixtures
from checks.queries import star, star_before, stored
from rostra.plans import gold, incremental
from rostra.sources.parts import PARTS, PartedTable, key_hash

FOLDER = "/root/testdata/sf0.001"


def files_of(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def part_of(name):
    return int(name.split("/part=")[1].split("/")[0])


def table(spark, tmp_path, rows, key=("k",)):
    made = PartedTable(spark, str(tmp_path / "t"), rows.schema, list(key), parts=8)
    made.write(rows)
    return made


def rows_of(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v long")


def test_upsert_leaves_other_parts_alone(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [(f"k{i}", i) for i in range(200)]))
    before = files_of(made.path)
    parts = made.upsert(rows_of(spark, [("k7", -7)]))
    after = files_of(made.path)
    assert len(parts) == 1
    assert {f: t for f, t in before.items() if part_of(f) not in parts} == {f: t for f, t in after.items() if part_of(f) not in parts}
    assert not {f for f in before if part_of(f) in parts} & set(after)
    got = {r.k: r.v for r in made.read().collect()}
    assert got == {f"k{i}": i for i in range(200)} | {"k7": -7}
    made.upsert(rows_of(spark, [("new", 1), ("k8", None)]))
    got = {r.k: r.v for r in made.read().collect()}
    assert got["new"] == 1 and got["k8"] is None and len(got) == 201
    assert made.upsert(rows_of(spark, [])) == []


def test_upsert_again_changes_nothing(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [(f"k{i}", i) for i in range(50)]))
    batch = rows_of(spark, [("k1", 100), ("x", 5), (None, 3)])
    made.upsert(batch.where("k IS NOT NULL"))
    once = sorted(made.read().collect())
    made.upsert(batch.where("k IS NOT NULL"))
    assert sorted(made.read().collect()) == once


def test_repeated_keys_of_a_source_fail_and_change_nothing(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [("a", 1), ("b", 2)]))
    with pytest.raises(Exception, match="more than one source row"):
        made.upsert(rows_of(spark, [("a", 5), ("a", 6)]))
    assert sorted(map(tuple, made.read().collect())) == [("a", 1), ("b", 2)]


def test_an_upsert_shuffles_rows_once(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path, rows_of(spark, [(f"k{i}", i) for i in range(50)]))
    exchanges = []

    def replaced(self, rows, parts, placed=False):
        plan = rows if placed else self._placed(rows)
        exchanges.append(plan._jdf.queryExecution().executedPlan().toString().count("Exchange "))

    with monkeypatch.context() as patched:
        patched.setattr(PartedTable, "replace", replaced)
        made.upsert(rows_of(spark, [(f"k{i}", -i) for i in range(0, 90, 3)]))
    assert exchanges == [1]


@pytest.mark.parametrize("task_bytes", [1, 10**9])
def test_upsert_of_null_keys_and_of_two_columns(spark, tmp_path, monkeypatch, task_bytes):
    """Null keys match nothing, with one task for a part and with many."""
    monkeypatch.setattr("rostra.sources.parts._TASK_BYTES", task_bytes)
    old = [*[(f"k{i}", i) for i in range(60)], (None, 1), (None, 1), (None, 2)]
    made = table(spark, tmp_path / "one", rows_of(spark, old))
    made.upsert(rows_of(spark, [(None, 3), ("k1", -1), ("k2", None), ("x", 7)]))
    want = {(f"k{i}", i) for i in range(60)} - {("k1", 1), ("k2", 2)} | {("k1", -1), ("k2", None), ("x", 7)}
    got = [tuple(r) for r in made.read().collect()]
    assert sorted(got, key=str) == sorted([*want, (None, 1), (None, 1), (None, 2), (None, 3)], key=str)
    with pytest.raises(Exception, match="more than one source row"):
        made.upsert(rows_of(spark, [("k5", 5), ("k5", 6)]))

    wide = "a string, b long, v array<string>"
    old = [("p", 1, ["o"]), ("p", 2, ["o"]), ("p", None, ["o"]), (None, 1, ["o"]), ("q", 1, None)]
    made = table(spark, tmp_path / "two", spark.createDataFrame(old, wide), ("a", "b"))
    made.upsert(spark.createDataFrame([("p", 1, ["n"]), ("p", None, ["n"]), (None, 1, ["n"]), ("r", 1, ["n"])], wide))
    got = sorted(((r.a, r.b, r.v) for r in made.read().collect()), key=str)
    assert got == sorted([*old[1:], ("p", 1, ["n"]), ("p", None, ["n"]), (None, 1, ["n"]), ("r", 1, ["n"])], key=str)


def test_update_of_matched_rows(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [(f"k{i}", i) for i in range(40)]))
    before = files_of(made.path)
    parts = made.update(spark.createDataFrame([("k3", 30), ("none", 1)], "k string, w long"), {"v": F.col("w")})
    got = {r.k: r.v for r in made.read().collect()}
    assert got == {f"k{i}": i for i in range(40)} | {"k3": 30}
    assert all(files_of(made.path).get(f) == t for f, t in before.items() if part_of(f) not in parts)


def exchanges_of(monkeypatch, run):
    """Shuffles of the rows that replace parts."""
    found = []

    def replaced(self, rows, parts, placed=False):
        plan = rows if placed or "part" in rows.columns else self._placed(rows)
        found.append(plan._jdf.queryExecution().executedPlan().toString().count("Exchange "))

    with monkeypatch.context() as patched:
        patched.setattr(PartedTable, "replace", replaced)
        run()
    return found


def test_an_update_shuffles_rows_once_and_null_keys_match_nothing(spark, tmp_path, monkeypatch):
    old = [*[(f"k{i}", i) for i in range(50)], (None, 1), (None, 2)]
    made = table(spark, tmp_path, rows_of(spark, old))
    source = spark.createDataFrame([("k3", None), ("k4", 40), (None, 9), ("none", 1)], "k string, w long")
    assert exchanges_of(monkeypatch, lambda: made.update(source, {"v": F.col("w")})) == [1]
    made.update(source, {"v": F.col("w")})
    got = [tuple(r) for r in made.read().collect()]
    assert sorted(got, key=str) == sorted([*[r for r in old if r[0] not in ("k3", "k4")], ("k3", None), ("k4", 40)], key=str)
    with pytest.raises(Exception, match="more than one source row"):
        made.update(spark.createDataFrame([("k1", 5), ("k1", 6)], "k string, w long"), {"v": F.col("w")})


@pytest.mark.parametrize("task_bytes", [1, 10**9])
def test_many_groups_are_exchanged_in_one_shuffle(spark, tmp_path, monkeypatch, task_bytes):
    monkeypatch.setattr("rostra.sources.parts._TASK_BYTES", task_bytes)
    old = [*[(f"k{i}", n) for i in range(50) for n in (0, 1)], (None, 1)]
    made = table(spark, tmp_path, rows_of(spark, old))
    touched = rows_of(spark, [("k1", 0), ("k2", 0), ("new", 0), (None, 0)]).select(key_hash("k").alias("key"))
    # k2 vanishes; k9 is not touched, and what is said of it is left out.
    rows = rows_of(spark, [("k1", 7), ("new", 8), ("new", 9), (None, 3), (None, 4), ("k9", 99)])
    assert exchanges_of(monkeypatch, lambda: made.replace_groups(touched, rows, many=True)) == [1]
    made.replace_groups(touched, rows, many=True)
    got = [tuple(r) for r in made.read().collect()]
    kept = [r for r in old if r[0] not in ("k1", "k2", None)]
    assert sorted(got, key=str) == sorted([*kept, ("k1", 7), ("new", 8), ("new", 9), (None, 3), (None, 4)], key=str)


def test_groups_that_vanish(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [("a", 1), ("b", 2)]))
    gone = rows_of(spark, [("a", 0)]).select(key_hash("k").alias("key"))
    made.replace_groups(gone, rows_of(spark, []))
    assert [tuple(r) for r in made.read().collect()] == [("b", 2)]
    assert not os.path.exists(f"{made.path}/part={made.parts_of(rows_of(spark, [('a', 0)]))[0]}")


def test_null_keys_and_empty_tables(spark, tmp_path):
    empty = table(spark, tmp_path, rows_of(spark, []))
    assert empty.read().count() == 0 and empty.read().columns == ["k", "v"]
    empty.replace_groups(rows_of(spark, [(None, 0)]).select(key_hash("k").alias("key")), rows_of(spark, [(None, 4)]))
    assert [tuple(r) for r in empty.read().collect()] == [(None, 4)]
    with pytest.raises(ValueError):
        PartedTable(spark, "x", rows_of(spark, []).withColumnRenamed("v", "part").schema, ["k"])


def test_only_touched_parts_are_read(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [(f"k{i}", i) for i in range(100)]))
    plan = made.read([3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan and "PartitionFilters: [part#" in plan


def test_one_file_for_a_small_part(spark, tmp_path):
    made = table(spark, tmp_path, rows_of(spark, [(f"k{i}", i) for i in range(2000)]).repartition(7))
    assert len(files_of(made.path)) == 8


# ---- gold ----


@pytest.fixture(scope="module")
def stars(spark):
    fx = Fixtures(spark, FOLDER)
    return stored(star_before(fx)), stored(star(fx))


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)

    def rows(frame):
        return sorted(
            tuple(f"{v:.9f}" if isinstance(v, float) else repr(v) for v in r) for r in frame.select(*columns).collect()
        )

    assert rows(left) == rows(right)


def full(name, s):
    by_document = gold.figure_stance_by_document(s.mentions, s.documents, s.dates, s.categories)
    return {
        "mentions_by_period": lambda: gold.figure_mentions_by_period(s.mentions, s.dates, s.categories),
        "stance_by_period": lambda: gold.figure_stance_by_period(s.mentions, s.dates, s.categories),
        "stance_by_document": lambda: by_document,
        "stance_by_creator": lambda: gold.figure_stance_by_creator(by_document, s.creator_bridge, s.creators),
        "stance_by_subject": lambda: gold.figure_stance_by_subject(by_document, s.subject_bridge, s.subjects),
        "top_contexts": lambda: gold.top_stance_contexts(s.mentions, s.documents, s.dates, s.contexts, s.categories, s.audit),
    }[name]()


def test_refreshed_tables_equal_the_full_build(spark, tmp_path, stars):
    before, after = stars
    tables = incremental.GoldTables(spark, str(tmp_path))
    tables.build(before)
    changed = incremental.changed_documents(before, after)
    written = tables.refresh(before, after, changed)
    assert set(written) == set(incremental.GROUPS)
    for name in incremental.GROUPS:
        same(tables.read(name, after), full(name, after))


def test_a_refresh_that_broke_off_is_finished_by_the_same_call(spark, tmp_path, stars, monkeypatch):
    before, after = stars
    tables = incremental.GoldTables(spark, str(tmp_path), ("stance_by_creator",))
    tables.build(before)
    changed = incremental.changed_documents(before, after)
    replace = PartedTable.replace

    def broken(self, rows, parts):
        if self.path.endswith("stance_by_creator"):
            replace(self, rows.where(self.part() == parts[0]), parts[:1])
            raise OSError("broken off")
        replace(self, rows, parts)

    with monkeypatch.context() as patched:
        patched.setattr(PartedTable, "replace", broken)
        with pytest.raises(OSError):
            tables.refresh(before, after, changed)
    tables.refresh(before, after, changed)
    same(tables.read("stance_by_creator", after), full("stance_by_creator", after))


def test_one_document_touches_its_own_groups(spark, tmp_path, stars):
    _, after = stars
    tables = incremental.GoldTables(spark, str(tmp_path), ("stance_by_period", "stance_by_document", "top_contexts"))
    tables.build(after)
    before = {name: files_of(tmp_path / name) for name in tables.names}
    one = after.mentions.where("publication_month IS NOT NULL AND stance_score IS NOT NULL").agg(F.min("document_id")).first()[0]
    flipped = after.mentions.withColumn("stance_score", F.when(F.col("document_id") == one, -F.col("stance_score")).otherwise(F.col("stance_score")))
    now = incremental.Star(**{**vars(after), "mentions": flipped})
    changed = incremental.changed_documents(after, now)
    assert [r.document_id for r in changed.collect()] == [one]
    written = tables.refresh(after, now, changed)
    groups = after.mentions.where(F.col("document_id") == one).select("figure_id").distinct().count()
    for name in tables.names:
        assert 0 < len(written[name]) <= groups < PARTS
        files = files_of(tmp_path / name)
        kept = {f: t for f, t in before[name].items() if part_of(f) not in written[name]}
        assert kept and kept == {f: t for f, t in files.items() if part_of(f) not in written[name]}
        same(tables.read(name, now), full(name, now))


def test_nothing_changed(spark, tmp_path, stars):
    _, after = stars
    tables = incremental.GoldTables(spark, str(tmp_path), ("stance_by_subject",))
    tables.build(after)
    before = files_of(tmp_path)
    assert all(not parts for parts in tables.refresh(after, after, incremental.changed_documents(after, after)).values())
    assert files_of(tmp_path) == before
