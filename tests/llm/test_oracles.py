"""The queries against their DuckDB SQL: on the driver's smallest tables, and on rows with nulls, copies and ties."""

import math
import os
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from glyphmill.llm import registry
from glyphmill.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    rnd = random.Random(5)
    at = tmp_path_factory.mktemp("planted")
    words = [" ".join(rnd.choice(["Ab", "cd", "é", "ÀB", "x y", "Z"]) + str(rnd.randint(0, 60)) for _ in range(n)) for n in (0, 1, 3, 4, 5, 19, 20, 21, 60, 200)]
    texts = words + [None, " \n ", words[9], words[9].lower(), words[9] + " tail", words[8] + "\t" + words[7], words[7] * 3, words[2].upper(), words[6] + "\n" + words[6]]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "lang": ["en"] * len(texts), "source": ["s"] * len(texts), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), at / "documents.parquet")
    html = [None, "", "<p>a</p>", "<p>é</p>", "<p>a</p>", None, "<p>a</p>", "x" * 5000]
    pq.write_table(pa.table({"page_id": pa.array(range(len(html)), pa.int64()), "url": ["http://a.example/"] * len(html), "html": html}), at / "pages.parquet")
    base = [[rnd.gauss(0, 1) for _ in range(16)] for _ in range(6)]
    near = [[x + rnd.gauss(0, s) for x in v] for v in base for s in (0.05, 0.2, 0.4, 0.5)]
    odd = [None, [0.0] * 16, [None] + [1.0] * 15, [math.nan] + [1.0] * 15, [math.inf] * 16, [2 * x for x in base[0]], base[1]]
    rows = base + near + odd
    pq.write_table(pa.table({"vec_id": pa.array(range(len(rows)), pa.int64()), "embedding": pa.array(rows, pa.list_(pa.float32())), "label": pa.array([0] * len(rows), pa.int32())}), at / "embeddings.parquet")
    return str(at)


def plain(columns, rows):
    """Rows as text, columns by name: only whole numbers, strings and booleans occur."""
    order = sorted(range(len(columns)), key=lambda c: columns[c])
    return sorted(columns), sorted(repr([row[c] for c in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("tables", ["sf", "planted"])
def test_query_equals_its_oracle(spark, planted, name, tables):
    if tables == "sf" and not os.path.isdir(SF):
        pytest.skip("needs the driver's tables")
    at = SF if tables == "sf" else planted
    con = duckdb.connect()
    for file in os.listdir(at):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{at}/{file}'")
    got, expected = registry.QUERIES[name](spark, at), con.execute(ORACLES[name])
    rows = [tuple(r) for r in got.collect()]
    assert plain(got.columns, rows) == plain([c[0] for c in expected.description], expected.fetchall())
