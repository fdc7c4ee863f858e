"""The SQL twins of the corpus queries on rows that the given tables do not hold: links
between hosts, odd texts, rules that disagree."""

from __future__ import annotations

import random

import duckdb
import pytest

from cardwatch import config
from cardwatch.llm import queries


def both(spark, table, df, key):
    """(rows of the query, rows of its SQL) over a folder that holds one table."""
    root = config.scratch_path(spark, "twins")
    df.write.parquet(f"{root}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM "
                f"read_parquet('{config.local_path(root)}/{table}.parquet/*.parquet')")
    got = queries.queries()[key](spark, root)
    cur = con.execute(queries.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    return (sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))),
            sorted(map(repr, cur.fetchall())))


def texts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_repeats_of_odd_texts(spark):
    r = random.Random(3)
    base = "".join(r.choice("abc é\n") for _ in range(900))
    rows = [None, "", "x", base[:199], base, base[100:420] + "!" + base[100:301], "a" * 450,
            "б" * 130, base[5:204], base[:200], "z" + base[300:500] + "z" + base[501:701],
            "".join(r.choice("xyz") for _ in range(700))]
    got, want = both(spark, "documents", texts(spark, rows + rows[4:6]), "op8_suffix_dedup")
    assert got == want
    assert sum("0, 0, 'e3b0c442" in x for x in got) >= 2      # null and empty text


def test_quality_of_odd_texts(spark):
    r = random.Random(4)
    words = ["".join(r.choice("abcdef") for _ in range(r.randint(2, 9))) for _ in range(400)]

    def text(n, extra=()):
        out = [r.choice(words) for _ in range(n)] + list(extra)
        r.shuffle(out)
        return " ".join(out)

    rows = [text(r.randint(40, 120)) for _ in range(60)]
    rows += [text(60, ["#*$"] * 25 + ["|"] * 12) for _ in range(6)]
    rows += [text(60, ["STOP!!!"] * 40) for _ in range(6)]
    rows += ["\n".join(["one same line of words here"] * 12 + [text(60)]) for _ in range(4)]
    rows += ["a b c " * 30, "a a a a a " * 12, None, "", " \t\r\n", "ÀÉ " * 60, "w" * 3000]
    got, want = both(spark, "documents", texts(spark, rows), "op2_quality_rules")
    assert got == want
    verdicts = [x.rsplit(", ", 2)[1:] for x in got]
    assert ["False", "False)"] in verdicts and ["False", "True)"] in verdicts


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_along_links(spark, seed):
    r = random.Random(seed)
    hosts = ["a.org", "b.org", "x.com", "y.com", "example.org", *[f"h{k}.net" for k in range(25)]]
    rows = []
    for k in range(120):
        host = r.choice(hosts)
        path = r.choice(["/", "/fr/1", "/de/2", "/es/3", "/en/1", "", "/it?x"])
        links = "".join(r.choice(['<a href="https://{}/p">', "<IMG SRC='//{}/i.png'>",
                                  '<a HREF=http://{}>']).format(
            r.choice(hosts).upper() if r.random() < 0.2 else r.choice(hosts))
            for _ in range(r.randint(0, 3)))
        rows.append((k, f"https://{host}{path}", links or None))
    rows += [(800, "https://x.com/de/1", None), (801, "https://bad.net/", '<a href="//x.com/">')]
    rows += [(900, None, "<a href='//a.org'>"), (901, "no scheme", None), (902, "://", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got, want = both(spark, "pages", pages, "op9_link_graph")
    assert got == want
    free = [x for x in got if ".net'" in x]
    assert {"block" in x for x in free} == {True, False}
