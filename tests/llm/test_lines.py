from __future__ import annotations

import pytest
from odd import odd_docs

from wagerlens.llm import lines
from wagerlens.llm.queries import CHECKS, QUERIES

PAGES = "id long, host string, text string, boilerplate string"


def plain(rows, max_ratio, min_pages):
    """Texts without their host's boilerplate, by hand."""
    total, pages = {}, {}
    for _, host, text, _ in rows:
        total[host] = total.get(host, 0) + 1
        for line in {x.strip(" \t\r") for x in (text or "").split("\n")} - {""}:
            pages[host, line] = pages.get((host, line), 0) + 1
    out = []
    for i, host, text, extra in rows:
        if text is not None:
            keep = []
            for line in text.split("\n"):
                n = pages.get((host, line.strip(" \t\r")), 0)
                if n < min_pages or not n / total[host] > max_ratio:
                    keep.append(line)
            text = "\n".join(keep)
        out.append((i, host, text, extra))
    return out


def pages():
    rows = []
    for i in range(40):
        host = ["hot.example", "hot.example", "b.example", None, ""][i % 5]
        body = f"Story {i}\n\n  Subscribe now \t\r\nRead on {i % 7}"
        rows.append((i, host, body + ("\nSubscribe now" if i % 2 else ""), "kept"))
    rows += [(40, "hot.example", None, "kept"), (41, "hot.example", "", "kept"), (42, "one.example", "Only\nSubscribe now", "kept")]
    rows += [(43, "b.example", "Subscribe now", "kept"), (43, "b.example", "Subscribe now", "kept")]
    rows += [(44, "hot.example", "Subscribe now\n" + "long line " * 50_000, "kept")]
    return rows


@pytest.mark.parametrize("max_broadcast", [1000, 0])
def test_lines_above_the_ratio_go(spark, max_broadcast):
    rows = pages()
    frame = spark.createDataFrame(rows, PAGES)
    got = lines.drop_site_lines(frame, "text", "host", 0.3, 4, max_broadcast)
    assert got.columns == frame.columns
    key = lambda r: (r[0], str(r))
    want = plain(rows, 0.3, 4)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert any(r[2] == "" for r in want) and any("Subscribe" in (r[2] or "") for r in want)


def joins_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("max_list", [0, 1, 2])
def test_long_lists_are_joined_by_line(spark, max_list):
    rows = pages()
    frame = spark.createDataFrame(rows, PAGES)
    whole = lines.drop_site_lines(frame, "text", "host", 0.1, 2, dropped="n")
    got = lines.drop_site_lines(frame, "text", "host", 0.1, 2, dropped="n", max_list=max_list)
    assert got.columns == whole.columns and got.schema["n"].dataType == whole.schema["n"].dataType
    key = lambda r: (r[0], str(r))
    want = sorted(plain(rows, 0.1, 2), key=key)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=key) == want
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)
    assert "posexplode" in joins_of(got).lower()


def test_no_host_has_a_list_beyond_the_bound(spark):
    text = "\n".join(f"line {i}" for i in range(lines.MAX_LIST + 1))
    rows = [(i, "a", text + f"\nown {i}", "x") for i in range(6)]
    rows += [(9, "b", "one\ntwo", "x"), (10, None, None, "x")]
    got = lines.drop_site_lines(spark.createDataFrame(rows, PAGES), "text", "host", 0.3, 4)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows, 0.3, 4), key=str)
    assert "posexplode" in joins_of(got).lower()


def test_odd_documents_and_empty_table(spark):
    docs = odd_docs(spark)
    got = lines.drop_site_lines(docs, dropped="n_dropped")
    assert got.columns == [*docs.columns, "n_dropped"]
    assert got.count() == docs.count()
    assert lines.drop_site_lines(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    df = QUERIES["op5_site_line_frequency"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_query_against_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # hosts of the smallest table have too few pages
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = QUERIES["op5_site_line_frequency"](spark, sf_dir)
    cursor = con.execute(CHECKS["op5_site_line_frequency"])
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())
    assert sorted(map(tuple, df.collect())) == want
    assert sum(r[3] for r in want) > 0


@pytest.mark.parametrize("max_list", [1000, 0])
def test_a_page_of_many_lines_takes_no_longer_than_its_text(spark, max_list):
    import time

    often = "\n".join(f"often {i}" for i in range(20))
    rows = [(i, "a", f"{often}\nown {i}", "x") for i in range(5)]
    rows.append((9, "a", often + "\n" + "\n".join(f"line {i}" for i in range(200_000)), "x"))
    start = time.monotonic()
    got = lines.drop_site_lines(spark.createDataFrame(rows, PAGES), "text", "host", 0.3, 4, max_list=max_list)
    texts = {r[0]: r[2] for r in got.collect()}
    assert time.monotonic() - start < 60  # comparing every two lines takes many minutes
    assert texts[9].startswith("line 0\nline 1\n") and texts[9].count("\n") == 199_999
    assert texts[3] == "own 3"
