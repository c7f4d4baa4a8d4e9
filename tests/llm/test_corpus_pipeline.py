"""The pipeline's stages, each against what its operator says of its own input."""

from __future__ import annotations

import corpus_pipeline
import pytest
from llm_support import SF, clashing, docs_of, shipped  # noqa: F401
from test_dedup_and_near import brute_exact, brute_near
from test_warc_mix_decontaminate import brute_hits

from tallystone.llm import toxicity
from tallystone.llm.common import read
from tallystone.llm.mixing import MIX_COLUMNS


@pytest.fixture(scope="module")
def stages(shipped, tmp_path_factory):  # noqa: F811
    root = tmp_path_factory.mktemp("pipeline")
    out, docs = [], shipped.read.parquet(f"{SF}/documents.parquet")
    out.append(docs)
    for name, step in corpus_pipeline.STAGES:
        step(shipped, docs, SF).write.parquet(str(root / name))
        docs = shipped.read.parquet(str(root / name))
        out.append(docs)
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages_have_the_columns_of_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
    assert stages[-1].columns[: len(stages[0].columns)] == stages[0].columns


def test_each_stage_does_what_it_says(shipped, stages):  # noqa: F811
    docs, clean, exact, near, tested, mixed = stages
    learnt = toxicity.learn(docs, read(shipped, SF, "labels", "doc_id", "toxic"))
    assert ids(clean) == sorted(r.row.doc_id for r in toxicity.scored(docs, learnt).where("score < 0.7").collect())
    assert ids(exact) == sorted(g[0][2] for g in brute_exact(texts(clean)).values())
    classes = brute_near(texts(exact))
    assert sorted(classes[i][0] for i in ids(near)) == sorted({c for c, _ in classes.values()})
    items = [(r.item_id, r.text) for r in read(shipped, SF, "benchmark", "item_id", "text").collect()]
    assert ids(tested) == sorted(i for i, t in texts(near) if not brute_hits(t, items)[4])
    assert ids(mixed) == ids(tested)
    assert sorted(r.position for r in mixed.collect()) == list(range(tested.count()))


def test_whole_run_gives_the_last_stage(shipped, stages):  # noqa: F811
    got = corpus_pipeline.run(shipped, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (1, ""), (2, "a b"), (2, "a b")]])
def test_stages_on_odd_tables(shipped, rows):  # noqa: F811
    docs = clashing(docs_of(shipped, rows))
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(shipped, docs, SF)
        assert out.columns == docs.columns
        out.count()
    last = corpus_pipeline.STAGES[-1][1](shipped, docs.selectExpr("*", "1 as Position", "2 as slot"), SF)
    assert last.count() == len(rows) and [c for c in last.columns if c not in MIX_COLUMNS] == [c for c in docs.columns if c not in MIX_COLUMNS]
