"""The pipeline's stages, each held against a plain version on what its predecessor kept."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sessionlens.llm import pii, quality_rules
from sessionlens.llm import sentencepiece_scan as sp
from sessionlens.llm.shared import stored, table
from sessionlens.llm.source_mixing import MixConfig

from . import plain
from .test_search_and_mixing import plain_mixing

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "test-" + name.replace(" ", "-")))
    return out


def as_dict(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_stay(steps):
    assert all(x.dtypes == steps[0].dtypes for x in steps[:-1])
    assert steps[-1].columns == ["doc_id", "n_tokens", "token_ids"]


def test_quality_stage(steps):
    given, kept = as_dict(steps[0]), as_dict(steps[1])
    ids = sorted(given)
    counts = quality_rules.text_counts([given[d]["text"] for d in ids])
    failed = quality_rules.base_failed(counts)
    patterns = quality_rules.pattern_of(quality_rules.rule_votes(counts))
    seen, often = np.unique(patterns[~failed], return_counts=True)
    posterior = quality_rules.fit_label_model(seen, often).posterior(quality_rules.rule_votes(counts))
    assert set(kept) == {d for d, bad, p in zip(ids, failed, posterior, strict=True) if not bad and p >= 0.5}
    assert all(kept[d] == given[d] for d in kept)


def test_duplicate_stage(steps):
    given, kept = as_dict(steps[1]), as_dict(steps[2])
    groups = plain.components([(d, r["text"]) for d, r in given.items()], 5)
    assert set(kept) == {d for d, c in groups.items() if d == c}
    assert all(kept[d] == given[d] for d in kept)


def test_personal_data_stage(spark, steps):
    given, kept = as_dict(steps[2]), as_dict(steps[3])
    assert set(given) == set(kept)
    spans = {r["doc_id"]: r["found"] for r in pii.spans_found(steps[2]).collect()}
    for d, r in given.items():
        text, at, out = r["text"], 0, ""
        for x in spans[d]:
            if x["start"] >= at:
                out += text[at : x["start"]] + f"<{x['kind'].upper()}>"
            at = max(at, x["end"])
        out += text[at:]
        assert kept[d]["text"] == out and kept[d]["n_chars"] == len(out)
        assert (kept[d]["lang"], kept[d]["source"]) == (r["lang"], r["source"])


def test_mixing_stage(steps):
    given, made = steps[3].collect(), steps[4].collect()
    times = plain_mixing([(r["doc_id"], r["text"], r["source"]) for r in given], MixConfig())
    assert Counter((r["doc_id"], r["source"]) for r in made) == times
    assert set(made) == set(given)


def test_token_stage(steps):
    library = sp.pieces().library
    given = Counter((r["doc_id"], tuple(library.encode(r["text"] or ""))) for r in steps[4].collect())
    assert Counter((r["doc_id"], tuple(r["token_ids"])) for r in steps[5].collect()) == given


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_nulls_in_every_column(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, None)], table(spark, SF, "documents").schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()


def test_duplicate_stage_keeps_null_and_repeated_ids(spark):
    a, b, c, d, e = (" ".join(f"{w}{i}" for i in range(60)) for w in ("north", "south", "east", "west", "tide"))
    given = [(None, a), (None, b), (None, b), (None, c), (1, c), (2, d), (2, d), (2, e), (3, e), (4, ""), (4, ""), (None, None), (5, d + " more"), (None, a + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in given], table(spark, SF, "documents").schema)
    out = [(r["doc_id"], r["text"]) for r in STAGES["near-duplicates"](spark, docs, SF).collect()]
    texts = Counter(t for _, t in out)
    assert texts[b] == texts[c] == texts[d] == texts[e] == 1 and texts[a] + texts[a + " more"] == 1  # one of each group
    assert (1, c) in out and (4, "") in out and texts[""] == 1 and (None, b) in out and (None, None) in out
    assert len(out) == 7 and d + " more" not in texts
