import random
from array import array

import pytest
from tokenizers import Tokenizer

from corvane.llm import bpe
from corvane.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def pair():
    path = tokenizer_path()
    with open(path, encoding="utf-8") as f:
        return Tokenizer.from_file(path), bpe.TrieTokenizer(f.read())


def test_equals_the_library_on_all_kinds_of_characters(pair):
    theirs, ours = pair
    rng = random.Random(2)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, rng.choices(points[:0x3000], k=40))) for _ in range(500)] + [f"a{chr(c)}b {chr(c)}1{chr(c)}" for c in rng.sample(points, 4000)]
    texts += ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 3000, "=-" * 2000, "don't we'll \t\n  end  ", "aaaa" * 99]
    for t, ids, e in zip(texts, ours.encode_batch(texts), theirs.encode_batch(texts, add_special_tokens=False)):
        assert list(memoryview(ids).cast("I")) == e.ids, t
        assert ours.decode(ids) == theirs.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("shape", ["{c}'ll", "a{c}b1{c}1 {c} !{c}{c}a"])
def test_every_code_point_beside_letters_digits_spaces_and_apostrophes(pair, shape):
    theirs, ours = pair
    every = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x110000))]
    texts = ["\n".join(shape.format(c=c) for c in every[i : i + 512]) for i in range(0, len(every), 512)]
    for t, ids, e in zip(texts, ours.encode_batch(texts), theirs.encode_batch(texts, add_special_tokens=False)):
        assert ids == array("I", e.ids).tobytes(), t


def test_what_is_remembered_is_bounded(pair, monkeypatch):
    theirs, ours = pair
    monkeypatch.setattr(bpe, "REMEMBERED", 1 << 16)
    monkeypatch.setattr(bpe, "PAIRS", 64)
    rng = random.Random(3)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcdeé", k=rng.choice([3, 8, 400]))) for _ in range(200))]
        assert list(memoryview(ours.encode_batch(texts)[0]).cast("I")) == theirs.encode(texts[0], add_special_tokens=False).ids
        assert len(ours._apart) <= 64 and not any(isinstance(w, str) and len(w) > bpe.LONGEST for w in ours.known)
    assert ours._held < 1 << 18


def test_other_kinds_of_tokenizer_are_refused():
    with pytest.raises(ValueError):
        bpe.read_definition(tokenizer_path("word_bpe_49k.json"))


def test_every_token_encodes_as_itself(pair):
    assert all(pair[1].reachable(t) for b, t in ((b, t) for t, b in pair[1].bytes.items()) if b != b"<|endoftext|>")


def test_operator_on_edge_rows(make, pair, corpus):
    rows = [*corpus, (None, "x"), (3, "again"), (3, "again")]
    out = bpe.encode_and_decode(make(rows), tokenizer_path()).collect()
    assert len(out) == len(rows)
    text = dict(corpus)
    for r in out:
        if r.doc_id is not None and r.decoded != "again":
            assert r.decoded == (text[r.doc_id] or "")
            assert list(memoryview(bytes(r.ids)).cast("I")) == pair[0].encode(text[r.doc_id] or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids) // 4
    assert bpe.encode_and_decode(make([]), tokenizer_path()).collect() == []
    docs = make([(1, None), (2, "b")])
    tokens = bpe.with_tokens(docs.withColumnRenamed("digest", "ids"), tokenizer_path())
    assert all(r.round_trip for r in tokens.collect()) and tokens.columns.count("ids") == 1


def test_driver_asks_for_character_classes_without_an_object_each():
    """All code points pass through the driver once; what they take there, and leave behind, is bounded (149 MB before)."""
    import tracemalloc

    tracemalloc.start()
    try:
        found = bpe.split_patterns.__wrapped__()
        left, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert found == bpe.split_patterns()
    assert peak < 60 << 20 and left < 4 << 20
