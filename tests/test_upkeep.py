"""Gold kept up to date against a full rebuild."""

from __future__ import annotations

from datetime import timedelta

from conftest import at, rows, same
from pyspark.sql import functions as F

from wagerlens.plans import finance, silver, upkeep
from wagerlens.schemas import FILE_SCHEMAS
from wagerlens.sources import bronze, tables
from wagerlens.sources.scratch import WorkTables

RUN = at("2024-03-01")


def load(spark, root, n, tx, players, buckets=16):
    moment = RUN + timedelta(days=n)
    for dataset, name, data in (("transactions", upkeep.TX, tx), ("players", upkeep.PLAYERS, players)):
        frame = spark.createDataFrame(data, FILE_SCHEMAS[dataset])
        if dataset == "players":
            frame = frame.withColumn("created_at", F.to_date("created_at"))
        bronze.backfill(spark, f"{root}/b", dataset, bronze.with_stamp(frame, dataset, moment))
        silver.refresh(spark, name, f"{root}/b", f"{root}/s", moment, buckets=buckets, keep_retired=True)
    return upkeep.refresh_summary(spark, f"{root}/s", f"{root}/g", WorkTables(spark, f"{root}/w{n}"), RUN, buckets)


def rebuilt(spark, root):
    return finance.financial_summary(
        tables.read_table(spark, f"{root}/s/{upkeep.TX}"), tables.read_table(spark, f"{root}/s/{upkeep.PLAYERS}"), RUN
    )


def check(spark, root):
    got, want = upkeep.read_summary(spark, f"{root}/g"), rebuilt(spark, root)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    cities = tables.read_table(spark, f"{root}/g/cities").drop("_gold_processed_at")
    assert same(cities, finance.city_metrics(want.select("*")))


def tx(i, player, kind, amount, moment):
    return (f"t{i}", player, kind, amount, at(moment))


def person(player, city):
    return {"player_id": player, "email": "e", "city": city, "created_at": at("2023-01-01").date()}


def test_loads_equal_a_rebuild(spark, root, monkeypatch):
    kinds = ["deposit", "bet", "withdraw"]
    names = [f"p{i}" for i in range(60)]
    first = [tx(i, names[i % 60], kinds[i % 3], 10.0 + i, f"2024-01-{i % 20 + 1:02d} 10:00:00") for i in range(300)]
    first += [tx(900, None, "bet", 5.0, "2024-01-01"), tx(901, "stranger", "bet", 5.0, "2024-01-01")]
    fields = FILE_SCHEMAS["players"].names
    people = [tuple(person(n, f"city{i % 4}" if i % 7 else None)[f] for f in fields) for i, n in enumerate(names)]
    assert load(spark, root, 0, first, people) == 60
    check(spark, root)

    # New rows of two players, one of them new, and a day that is known already.
    opened, read = {}, tables.read_table

    def watched(spark, path, since=None, buckets=None):
        found = read(spark, path, since, buckets)
        name = path.rsplit("/", 1)[1]
        opened.setdefault(name, set()).update(f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles() if "_bucket=" in f)
        return found

    monkeypatch.setattr(upkeep, "read_table", watched)
    new = [tx(400, "p1", "bet", 2.5, "2024-01-02 12:00:00"), tx(401, "p1", "deposit", 1.0, "2024-02-05"),
           tx(402, "new", "deposit", 7.0, "2024-02-06")]
    newcomer = [tuple(person("new", "city9")[f] for f in fields)]
    assert load(spark, root, 1, new, newcomer) == 2
    assert len(opened["player_days"]) <= 2 and len(opened["player_metrics"]) <= 2
    assert upkeep.TX not in opened  # no stored transaction is read
    monkeypatch.undo()
    check(spark, root)

    # A replaced transaction moves to another player, a player moves to another city.
    moved = [tx(3, "p7", "bet", 99.0, "2024-02-07"), tx(402, "new", "deposit", 8.0, "2024-02-06")]
    away = [tuple(person("p2", "city9")[f] for f in fields)]
    load(spark, root, 2, moved, away)
    check(spark, root)
    # The only transaction of a player goes to another: the player leaves the summary, and its city too.
    load(spark, root, 3, [tx(402, "p1", "deposit", 8.0, "2024-02-06")], [tuple(person("p2", "city1")[f] for f in fields)])
    check(spark, root)
    assert "city9" not in {r.city for r in tables.read_table(spark, f"{root}/g/cities").collect()}
    assert load(spark, root, 4, [], []) == 0
    check(spark, root)


def test_runs_that_keep_the_summary_equal_runs_that_rebuild_it(spark, root, lake):
    from dataclasses import replace

    from wagerlens.plans import medallion
    from wagerlens.sources.files import write_file

    for n, condition in ((1, "timestamp < '2024-01-15'"), (2, "timestamp >= '2024-01-15'")):
        for dataset, file in medallion.FILES.items():
            df = lake.raw[dataset]
            if dataset == "affiliates":
                df = df.dropDuplicates(bronze.AFFILIATE_KEYS)
            elif dataset != "players":
                df = df.filter(condition)
            write_file(df, dataset, f"{root}/in{n}/{file}")
    plain = medallion.Options()
    found = {}
    for name, options in (("kept", replace(plain, upkeep=True, buckets=4)), ("rebuilt", plain)):
        for n in (1, 2):
            medallion.run(spark, f"{root}/in{n}", f"{root}/{name}", RUN + timedelta(days=n), options=options)
        layout = medallion.Layout(f"{root}/{name}")
        gold = medallion.read_gold(spark, layout)
        found[name] = [gold["fct_financial_summary"], tables.read_table(spark, f"{layout.gold}/fct_player_ltv")]
    for a, b in zip(found["kept"], found["rebuilt"], strict=True):
        assert a.count() > 100 and same(a, b)
