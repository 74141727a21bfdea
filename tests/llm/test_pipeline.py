"""The pipeline, stage by stage, against what each stage has to do."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from dawnpress.llm import mixing, quality, queries
from tests.llm.conftest import D, ODD
from tests.llm.test_ops import brute_classes, brute_tiles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that go into each stage, and what the last one returns."""
    d, out = spark.read.parquet(f"{D}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(d.collect())
        assert d.columns == COLUMNS, name
        d = stage(spark, d, D)
        d = spark.createDataFrame(d.collect(), d.schema)
    return [*out, d.collect()]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_quality_stage(stages):
    want = duckdb.sql(f"with documents as (from '{D}/documents.parquet') " + quality.ORACLE.strip().replace("with d as", ", d as", 1)).df()
    assert ids(stages[1]) == sorted(want[want["kept"]]["doc_id"].tolist()) and len(stages[1]) < len(stages[0])


def test_near_duplicates_stage(stages):
    first = {i for i, _, c in brute_classes([(r["doc_id"], r["text"]) for r in stages[1]]) if i == c}
    assert ids(stages[2]) == sorted(first) and len(first) < len(stages[1])


def test_decontamination_stage(stages):
    words = lambda t: re.findall(rb"[^\x09-\x0d\x20-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", (t or "").encode().lower())
    items = [words(r[0]) for r in duckdb.sql(f"select text from '{D}/benchmark.parquet'").fetchall()]
    bad = set()
    for r in stages[2]:
        w = words(r["text"])
        grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for item in items:
            if any(tuple(item[k : k + 5]) in grams for k in range(len(item) - 4)):
                if sum(t[2] for t in brute_tiles(item, w, 5)) >= 0.5 * len(item):
                    bad.add(r["doc_id"])
    assert ids(stages[3]) == sorted(set(ids(stages[2])) - bad)


def test_mixing_stage(spark, stages):
    before, after = ({r["doc_id"]: r for r in rows} for rows in stages[3:5])
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for k, r in before.items()}
    taken, total = collections.Counter(ids(stages[4])), sum(size.values())
    assert set(after) <= set(before) and max(taken.values()) <= 3
    sources = sorted({r["source"] for r in before.values()})
    held = [sum(size[k] for k, r in before.items() if r["source"] == s) for s in sources]
    target = mixing.share_out(held, [(5, 2, 1)[i % 3] for i in range(len(sources))], 1.0, 3)
    assert sum(target) == pytest.approx(min(total, 3 * total))
    for s, t in zip(sources, target, strict=True):
        mine = [k for k, r in before.items() if r["source"] == s]
        assert abs(sum(taken[k] * size[k] for k in mine) - t) <= max(size[k] for k in mine)


def test_token_stage(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    of = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in stages[4]}
    start = 0
    for r in sorted(stages[5], key=lambda r: r["start"]):
        want = of[r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    assert ids(stages[5]) == ids(stages[4])


def test_odd_and_empty_tables(spark, tmp_path):
    """Odd rows, columns with the stages' own names, and empty tables, through all stages."""
    bench = spark.createDataFrame([(1, "a passage that is in no document of all these here"), (None, None)], "item_id long, text string")
    good = [r["text"] for r in quality.keep_good(spark.read.parquet(f"{D}/documents.parquet")).orderBy("doc_id").limit(3).collect()]
    rows = [*ODD, (None, good[0], "a"), (50, good[1], None), (50, good[1], None), (51, good[2], "b")]
    odd = spark.createDataFrame([(i, t, None, s, 1, 2, 3, "n") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, node long, size long, component_id string")
    for name, docs, items in (("odd", odd, bench), ("none", odd.where("false"), bench), ("free", odd, bench.where("false"))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        items.write.parquet(str(tmp_path / name / "benchmark.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert (len(got) == 0) == (name == "none")
        assert {r["doc_id"] for r in got} <= {None, 50, 51}
