"""Batches that come once, twice, broken or in any order."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import customers, money, tables, transactions
from ledgerloom.operators.cleaning import TRANSACTION_ORDER, dedupe_keep_first
from ledgerloom.sources import storage
from ledgerloom.sources.schemas import CUSTOMERS, TRANSACTIONS
from ledgerloom.state import loads
from ledgerloom.state.batches import BatchTable
from ledgerloom.state.distinct_counts import DistinctCounts, estimates, sketch_bound, sketches
from ledgerloom.state.first_copies import FirstCopies

PAIR = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIR)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_batch_is_taken_once(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), PAIR)
    assert table.batches() == [] and table.read().count() == 0
    assert table.append("one", pairs(spark, [(1, "a"), (1, "a"), (None, None)]))
    assert not table.append("one", pairs(spark, [(1, "a"), (1, "a"), (None, None)]))
    assert table.append("none", pairs(spark, []))
    assert table.append("two", pairs(spark, [(2, "b")]))
    assert rows(table.read()) == rows(pairs(spark, [(1, "a"), (1, "a"), (None, None), (2, "b")]))
    assert [(b.number, b.batch, b.rows) for b in table.batches()] == [(0, "one", 3), (1, "none", 0), (2, "two", 1)]


def test_keys_that_are_stored_are_left_out(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), PAIR)
    table.append("one", pairs(spark, [(2, "c"), (2, "b"), (1, "a"), (None, "n")]), ["k"], ["v"])
    table.append("two", pairs(spark, [(2, "a"), (3, "z"), (None, "m")]), ["k"], ["v"])
    assert rows(table.read()) == rows(pairs(spark, [(1, "a"), (2, "b"), (3, "z"), (None, "n")]))


def test_a_load_that_breaks_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    table = BatchTable(spark, str(tmp_path / "t"), PAIR)
    table.append("one", pairs(spark, [(1, "a")]))
    enter = BatchTable._enter
    monkeypatch.setattr(BatchTable, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.append("two", pairs(spark, [(2, "b")]))
    monkeypatch.setattr(BatchTable, "_enter", enter)
    assert rows(table.read()) == [(1, "a")]
    assert table.append("two", pairs(spark, [(2, "b")]))
    assert not table.append("two", pairs(spark, [(2, "b")]))
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    assert table.vacuum() == 1
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_two_writers_at_once(spark, tmp_path):
    first, second = (BatchTable(spark, str(tmp_path / "t"), PAIR) for _ in range(2))

    def slow(stored):
        """Another load of an overlapping batch comes first."""
        if not stored.count():
            assert second.append("other", pairs(spark, [(1, "theirs"), (2, "theirs")]), ["k"])
        return pairs(spark, [(1, "mine"), (3, "mine")]).join(stored.select("k"), "k", "left_anti")

    assert first.fold("mine", slow)
    assert rows(first.read()) == [(1, "theirs"), (2, "theirs"), (3, "mine")]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_replacement_keeps_the_batches_known(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), PAIR)
    for k in range(3):
        table.append(f"b{k}", pairs(spark, [(k, "x"), (9, "x")]))
    seen = table.batches()
    table.replace(lambda stored: stored.distinct())
    assert rows(table.read()) == [(0, "x"), (1, "x"), (2, "x"), (9, "x")]
    assert table.read(seen).count() == 6
    assert not table.append("b1", pairs(spark, [(1, "x")]))
    assert table.append("b3", pairs(spark, [(3, "x")]))
    assert table.read().count() == 5
    assert table.vacuum() == 3 and table.read().count() == 5


def people(spark, *numbers):
    return customers(spark, [(f"C{n}", "R", "2022-01-01", False, None) for n in numbers])


def csv_batch(spark, folder, first, days):
    """Customers from ``first`` on with an account each, and their transactions."""
    some = [(f"C{n}", "R", "2022-01-01", False, None) for n in range(first, first + 3)]
    held = [(f"A{n}", f"C{n}", "P") for n in range(first, first + 3)]
    moved = [(f"T{n}-{d[5:7]}", f"A{n}", d, "deposit", "2.50") for n in range(first, first + 3) for d in days]
    bound = tables(spark, some, held, moved, [("2023-01", f"A{first}", f"C{first}", "P", "R", "1.25")])
    for name, df in bound.named().items():
        storage.write_csv(df, f"{folder}/{name}.csv")


def test_csv_batches(spark, tmp_path, monkeypatch):
    raw, stored = str(tmp_path / "raw"), str(tmp_path / "stored")
    csv_batch(spark, f"{raw}/1", 0, ["2023-01-05", "2023-02-05"])
    csv_batch(spark, f"{raw}/2", 2, ["2023-03-05"])  # customer and account 2 again
    taken, _ = loads.load_batch(spark, f"{raw}/1", stored, "1", strict=True)
    assert all(taken.values())
    add = loads.add_batch

    def breaks(spark, folder, batch, name, df):
        if name == "transactions":
            raise RuntimeError("lost")
        return add(spark, folder, batch, name, df)

    monkeypatch.setattr(loads, "add_batch", breaks)
    with pytest.raises(RuntimeError):
        loads.load_batch(spark, f"{raw}/2", stored, "2")
    monkeypatch.setattr(loads, "add_batch", add)
    taken, audit = loads.load_batch(spark, f"{raw}/2", stored, "2")
    assert taken == {"customers": False, "accounts": False, "transactions": True, "monthly_revenue": True}
    assert audit.filter("violations > 0").count() == 0
    again, _ = loads.load_batch(spark, f"{raw}/2", stored, "2", strict=True)
    assert not any(again.values())
    t = loads.read_loaded(spark, stored)
    assert {n: df.count() for n, df in t.named().items()} == {"customers": 5, "accounts": 5, "transactions": 9, "monthly_revenue": 2}
    assert t.transactions.agg(F.sum("amount")).first()[0] == money("22.50")


def test_strict_load_publishes_nothing(spark, tmp_path):
    raw, stored = str(tmp_path / "raw"), str(tmp_path / "stored")
    csv_batch(spark, raw, 0, ["2023-01-05"])
    storage.write_csv(people(spark, 0, 1), f"{raw}/customers.csv")  # account 2 has no owner now
    with pytest.raises(storage.IntegrityError):
        loads.load_batch(spark, raw, stored, "1", strict=True)
    assert all(df.count() == 0 for df in loads.read_loaded(spark, stored).named().values())


def copies(spark):
    pick = random.Random(2)
    made = []
    for k in range(240):
        key = None if k % 40 == 0 else "T0" if k % 3 == 0 else f"T{pick.randrange(40)}"
        made.append((key, f"A{pick.randrange(3)}", f"2023-0{pick.randrange(1, 4)}-0{pick.randrange(1, 4)}", "fee", "1.00", "CAD", None if k % 5 else "x"))
    return transactions(spark, made)


def test_keep_first_for_every_order_of_batches(spark, tmp_path):
    all_rows = copies(spark).withColumn("batch", F.pmod(F.hash("transaction_date", "description", "account_id"), F.lit(3)))
    wanted = rows(dedupe_keep_first(all_rows.drop("batch"), ["transaction_id"], TRANSACTION_ORDER))
    for order in itertools.permutations(range(3)):
        state = FirstCopies(spark, str(tmp_path / f"{order}"), TRANSACTIONS, ["transaction_id"], TRANSACTION_ORDER)
        for step, k in enumerate(order):
            part = all_rows.where(F.col("batch") == k).drop("batch")
            assert state.add(f"b{k}", part)
            assert not state.add(f"b{k}", part)
            if step == 1:
                state.compact()
        # what was there already, under another id, adds nothing
        before = len(state.table.batches())
        assert state.add("again", all_rows.drop("batch"))
        assert state.table.batches()[before].rows == 0
        assert rows(state.current()) == wanted


def test_keep_first_of_many_small_batches(spark, tmp_path):
    state = FirstCopies(spark, str(tmp_path / "s"), PAIR, ["k"], ["v"])
    given = [(k % 4, "edcba"[k % 5]) for k in range(12)]
    for k in range(0, 12, 3):
        state.add(str(k), pairs(spark, given[k : k + 3]))
    assert rows(state.current()) == rows(dedupe_keep_first(pairs(spark, given), ["k"], ["v"]))


ACTIVITY = "who string, month string, region string"
GROUPS = {"month": T.StringType(), "region": T.StringType()}


def activity(seed, number, people):
    pick = random.Random(seed)
    return [
        (None if k % 50 == 0 else f"u{pick.randrange(people)}", f"2023-{pick.randrange(1, 13):02d}", pick.choice(["N", "S", None])) for k in range(number)
    ]


def test_distinct_counts_from_bitmaps(spark, tmp_path):
    given = [activity(1, 900, 80), activity(2, 900, 200), activity(3, 50, 300)]
    state = DistinctCounts(spark, str(tmp_path / "d"), "who", T.StringType(), GROUPS)
    for k, part in enumerate(given):
        df = spark.createDataFrame(part, ACTIVITY)
        assert state.add(f"b{k}", df)
        assert not state.add(f"b{k}", df)
    every = [r for part in given for r in part if r[0] is not None]
    numbers = [r.number for r in state.dictionary.read().collect()]
    assert sorted(numbers) == list(range(1, len({r[0] for r in every}) + 1))

    def counted(key):
        found = {}
        for who, month, region in every:
            found.setdefault(key(month, region), set()).add(who)
        return {k: len(v) for k, v in found.items()}

    by_month = {(r.month, r.region): r.n for r in state.count(F.col("month"), F.col("region"), name="n").collect()}
    assert by_month == counted(lambda m, r: (m, r))
    quarter = F.ceil(F.substring("month", 6, 2).cast("int") / 3).alias("quarter")
    assert {r.quarter: r.n for r in state.count(quarter, name="n").collect()} == counted(lambda m, r: -(-int(m[5:]) // 3))
    assert state.count(name="n").first().n == len({r[0] for r in every})


def test_a_broken_batch_goes_on(spark, tmp_path, monkeypatch):
    state = DistinctCounts(spark, str(tmp_path / "d"), "who", T.StringType(), GROUPS)
    df = spark.createDataFrame(activity(5, 300, 60), ACTIVITY)
    append = BatchTable.append
    monkeypatch.setattr(BatchTable, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.add("b", df)
    monkeypatch.setattr(BatchTable, "append", append)
    assert state.count(name="n").first().n == 0
    assert state.add("b", df)
    assert state.count(name="n").first().n == df.where("who is not null").select("who").distinct().count()


def test_more_keys_than_one_bitmap_holds(spark, tmp_path):
    state = DistinctCounts(spark, str(tmp_path / "d"), "who", T.LongType(), {"day": T.DateType()})
    day = F.lit(datetime.date(2023, 1, 1))
    state.add("a", spark.range(70_000).select(F.col("id").alias("who"), day.alias("day")))
    state.add("b", spark.range(60_000, 75_000).select(F.col("id").alias("who"), F.date_add(day, 1).alias("day")))
    assert {r.day.day: r.n for r in state.count(F.col("day"), name="n").collect()} == {1: 70_000, 2: 15_000}
    assert state.count(name="n").first().n == 75_000


def test_sketches_unite_within_their_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("who"), (F.col("id") % 8).alias("month"))
    stored = sketches(df, "who", ["month"])
    for by in ([], [F.col("month") < 4]):
        exact = df.groupBy(*[c.alias("half") for c in by]).agg(F.countDistinct("who").alias("exact")).collect()
        guessed = estimates(stored, *[c.alias("half") for c in by], name="n").collect()
        assert len(exact) == len(guessed)
        for a, b in zip(sorted(exact), sorted(guessed)):
            assert abs(a[-1] - b[-1]) <= sketch_bound() * a[-1]
