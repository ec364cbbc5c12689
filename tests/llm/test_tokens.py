"""Token counts, token files and pieces against the libraries."""

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from spokeline.llm import elias_fano, pieces, token_counts, token_files

from .conftest import as_dicts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGE = [None, "", " ", "a", "Don't stop <|endoftext|> now<|endoftext|>", "ÄÖ ß ﬁ é ́x 😀", "x\x1cy　z  w\x85v",
        "1234 56.78\n\n\tq", "▁▁ a▁b", "\x00 nul", "ΑΣ ΣΑΣ. ΟΔΟΣ<|startoftext|>ΟΔΟΣ"]


def prose(rng, n):
    syllables = ["th", "er", "on", "an", "re", "ä", "ß", "zz", "'s", "12", ",", ".", "-", "<|endoftext|>"]
    return "".join(
        "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) + rng.choice([" ", " ", " ", "  ", "\n", "\t"])
        for _ in range(n)
    )


def test_counts_of_short_and_huge_documents(docs_of):
    rng = random.Random(1)
    texts = EDGE + [prose(rng, 3000), "q" * 9000, "ab " * 2000, prose(rng, 200) + "x" * 3000 + prose(rng, 900), " " * 5000]
    texts += ["<|endoftext|>" * 400, "漢字" * 1500]
    rows = [*enumerate(texts), (len(EDGE), texts[len(EDGE)]), (None, texts[len(EDGE)])]
    tok = token_counts.tokenizer(BYTES)
    expected = sorted(
        ((-1 if i is None else i), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False)))
        for i, t in rows
    )
    found = as_dicts(token_counts.token_counts(docs_of(rows), BYTES, limit=50, chunk=1024, overlap=256))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in found) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 50) for r in found)
    assert token_counts.token_counts(docs_of([]), BYTES).collect() == []


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_widening(path):
    rng, tok = random.Random(2), token_counts.tokenizer(path)
    for text in (prose(rng, 500), "a" * 2000 + " " + prose(rng, 300), prose(rng, 40) + "é" * 1500, "b" * 700):
        assert token_counts.widened_count(tok, text, 300, 140) == len(tok.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("numbers", [[], [0], [5], [0, 0, 0], [1, 1, 7, 900, 900, 10**12], list(range(0, 5000, 7))])
def test_elias_fano(numbers):
    coded = elias_fano.Ascending.of(np.array(numbers, dtype=np.uint64))
    again, end = elias_fano.Ascending.read(memoryview(b"xx" + coded.to_bytes()), 2)
    assert again.all().tolist() == numbers and [again.select(i) for i in range(len(numbers))] == numbers
    assert end == 2 + len(coded.to_bytes())


def test_elias_fano_is_small():
    rng = np.random.default_rng(1)
    ends = np.cumsum(rng.integers(1, 2000, 10_000))
    assert len(elias_fano.Ascending.of(ends).to_bytes()) * 8 / 10_000 < 2 + np.log2(1000) + 1.6


@pytest.mark.parametrize("file_ids", [1, 50, 1 << 22])
def test_token_files(spark, docs_of, tmp_path, file_ids):
    rng = random.Random(4)
    texts = [*EDGE, *(prose(rng, rng.randrange(60)) for _ in range(60)), "w" * 300]
    rows = [(5 * i - 40, t) for i, t in enumerate(texts)] + [(None, "no id"), (2**62, "far"), (-(2**62), "near")]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs_of(shuffled), WORDS, folder, file_ids=file_ids)
    tok, start, expected = token_counts.tokenizer(WORDS), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected
    for path in (tmp_path / "tokens" / "ids").glob("*.eft"):
        file = elias_fano.TokenFile(path.read_bytes())
        assert [(file.doc_id(k), len(file.document(k))) for k in range(file.n_docs)] == [(r[0], r[2]) for r in file.rows()]


def test_token_files_of_nothing(spark, docs_of, tmp_path):
    token_files.write_tokens(docs_of([]), WORDS, str(tmp_path / "t"))
    assert token_files.read_tokens(spark, str(tmp_path / "t")).collect() == []


def test_words_stand_alone():
    rng, encoder = random.Random(5), token_files.WordEncoder(WORDS)
    alphabet = "aAbß'<|>endoftxs \t\n ́̈éΣσİ1.,\x1c　"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(500)]
    whole = [np.array(encoder.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoder.ids(texts) == whole


def test_only_known_tokenizers_are_cut_at_spaces():
    assert isinstance(token_files.encoder_of(WORDS), token_files.WordEncoder)
    assert type(token_files.encoder_of(BYTES)) is token_files.TextEncoder
    known = json.loads(token_counts.tokenizer(WORDS).to_str())
    assert token_files.drops_spaces(known)
    cuts = known["pre_tokenizer"]["pretokenizers"]
    for key, value in [
        ("normalizer", {"type": "Prepend", "prepend": "_"}),
        ("pre_tokenizer", None),
        ("pre_tokenizer", cuts[1]),
        ("pre_tokenizer", {**cuts[0], "behavior": "Isolated"}),
        ("pre_tokenizer", {**cuts[0], "pattern": {"Regex": "[a-z ]+"}}),
        ("added_tokens", [{**known["added_tokens"][0], "lstrip": True}]),
        ("added_tokens", [{**known["added_tokens"][0], "content": "two words"}]),
        ("model", {**known["model"], "dropout": 0.1}),
    ]:
        assert not token_files.drops_spaces({**known, key: value})


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("size", [1, 100, 1 << 20])
def test_encoders_agree_with_the_library(monkeypatch, path, size):
    monkeypatch.setattr(token_files, "TEXT_BYTES", size)
    monkeypatch.setattr(token_files, "CACHED_WORDS", 20)
    rng, encoder = random.Random(size), token_files.encoder_of(path)
    texts = [t or "" for t in EDGE] + [prose(rng, rng.randrange(40)) for _ in range(80)] + ["w" * 300, " \t"]
    whole = [np.array(encoder.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    found = []
    rows = pa.RecordBatch.from_arrays([pa.array(["skipped", *texts])], ["text"]).slice(1)
    for some in token_files._pieces(rows):
        ids, cuts = encoder.coded(some.column("text"))
        found += [bytes(ids[low:high]) for low, high in zip(cuts, cuts[1:])]
    assert found == whole


def test_token_files_of_a_tokenizer_that_keeps_spaces(spark, docs_of, tmp_path):
    texts = ["a  b", " ", "x\n\n y ", None]
    token_files.write_tokens(docs_of([*enumerate(texts)]), BYTES, str(tmp_path / "t"))
    tok = token_counts.tokenizer(BYTES)
    found = {r.doc_id: r.n_tokens for r in token_files.read_tokens(spark, str(tmp_path / "t")).collect()}
    assert found == {i: len(tok.encode(t or "", add_special_tokens=False)) + 1 for i, t in enumerate(texts)}


@pytest.mark.parametrize("unnamed", [0, 3, 130, 200])
def test_rows_of_a_file_are_read_in_stretches(monkeypatch, unnamed):
    monkeypatch.setattr(elias_fano, "STRETCH", 64)
    rng = random.Random(unnamed)
    names = [None] * unnamed + sorted(rng.randrange(-(2**63), 2**63) for _ in range(200 - unnamed))
    lengths = [rng.choice([0, 1, 1, 2, 900]) for _ in names]
    ids = np.array([rng.randrange(2**16) for _ in range(sum(lengths))], "<u2")
    file = elias_fano.TokenFile(elias_fano.pack(names, lengths, ids.tobytes(), 2))
    begins = np.cumsum([0, *lengths]).tolist()
    assert [r[:3] for r in file.rows()] == list(zip(names, begins, lengths))
    assert [r[3] for r in file.rows()] == [zlib.crc32(ids[a : a + n].astype("<u4").tobytes()) for a, n in zip(begins, lengths)]


def unigram():
    """The same vocabulary read as a unigram model, with the library for its results."""
    from spokeline.llm.pieces import _fields

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    proto, out = open(MODEL, "rb").read(), b""
    for number, part in _fields(proto):
        if number == 2:
            part += varint(3 << 3) + varint(1)  # model_type again: the last one counts
        out += varint(number << 3 | 2) + varint(len(part)) + part
    return out


@pytest.mark.parametrize("kind", ["merge", "unigram"])
def test_pieces_are_the_librarys(kind):
    model = pieces.Pieces(MODEL) if kind == "merge" else pieces.Pieces(proto=unigram())
    assert model.kind == (pieces.BPE if kind == "merge" else pieces.UNIGRAM) and model.splits
    rng = random.Random(6)
    alphabet = "  ▁aeinrstthdäß漢字Ωж😀.,'\n0123<>x"
    texts = [t or "" for t in EDGE] + [prose(rng, 80) for _ in range(20)]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(400)]
    texts += [" " * n + "the end" + " " * n for n in range(40)]
    for text in texts:
        ids = np.frombuffer(model.encode(text), "<u4").tolist()
        if kind == "merge":
            assert ids == model.library.encode(text), text
        else:  # several segmentations may share the best score
            score = lambda x: sum(model.score[i] for i in x)
            known = model.library.encode(text)
            assert score(ids) >= score(known) - 1e-3 * abs(score(known)), text
        assert model.decode(ids) == model.library.decode(ids) == text.replace("▁", " ")


def test_encode_decode_rows(docs_of):
    rows = [*enumerate(EDGE), (3, "a"), (None, "b c")]
    found = as_dicts(pieces.encode_decode(docs_of(rows), MODEL, with_ids=True))
    library = pieces.Pieces(MODEL).library
    assert sorted((str(r["doc_id"]), r["ids"]) for r in found) == sorted((str(i), library.encode(t or "")) for i, t in rows)
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in found)
    assert pieces.encode_decode(docs_of([]), MODEL).collect() == []
