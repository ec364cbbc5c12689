"""The pipeline against plain Python, stage by stage."""

import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline

from .conftest import words
from .test_exact_and_sharding import lowered
from .test_near_dedup import brute
from .test_quality_and_mixing import fair_mix, measured


def clean(row):
    m = measured(row[1])
    return not (m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"])


def expected(rows):
    bad, of = Counter(r[2] for r in rows if not clean(r)), Counter(r[2] for r in rows)
    assert all(bad[s] * 2 < of[s] for s in of)  # no host is near being rejected
    rows = [r for r in rows if clean(r)]
    last = {}
    for r in sorted(rows):
        last[lowered(r[1])] = r
    rows = list(last.values())
    stays = {i for i, _, _, kept in brute([r[:2] for r in rows], 5) if kept}
    rows = [r for r in rows if r[0] in stays]
    _, _, taken = fair_mix(rows)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for i, text, _ in rows:
        out += [(i, tuple(model.encode(text)))] * (taken[i] // len(words(text)))
    return sorted(out)


@pytest.fixture
def stored(docs_of, tmp_path):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(150):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(25, 90))]
        rows.append((i, " ".join(text), rng.choice(["a", "a", "b", "c"])))
        if i % 5 == 0:
            rows.append((1000 + i, rows[-1][1].upper(), "b"))
            text[3] = "changed"
            rows.append((2000 + i, " ".join(text), "c"))
        if i % 9 == 0:
            rows.append((3000 + i, "too short", "a"))
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    return rows, str(tmp_path)


def test_pipeline(spark, stored):
    rows, folder = stored
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in found) == expected(rows)
    assert all(r["round_trip"] for r in found)


def test_stages_keep_the_columns_and_take_empty_tables(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == []
        assert stage is corpus_pipeline.sentencepiece or out.columns == docs.columns


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_null_ids_and_repeated_rows(spark, docs_of):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(4)]
    near = [t + " more" for t in texts]
    rows = [(1, texts[0]), (1, texts[0]), (None, near[0]), (None, texts[1]), (None, texts[1].upper()), (None, near[1])]
    rows += [(None, texts[2]), (7, texts[3]), (7, texts[3]), (None, texts[3]), (None, None)]
    docs = corpus_pipeline.exact_duplicates(spark, docs_of(rows), "")
    exact = [(r["doc_id"], (r["text"] or "").lower()) for r in docs.collect()]
    assert Counter(exact) == Counter(
        [(1, texts[0]), (None, near[0]), (None, texts[1]), (None, near[1]), (None, texts[2]), (7, texts[3]), (None, "")]
    )
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    left = [(r["doc_id"], (r["text"] or "").lower().removesuffix(" more")) for r in out.collect()]
    assert Counter(left) == Counter([(1, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (None, "")])
