"""The merge rounds against the library whose ids they must give."""

import hashlib
import random

import numpy as np
import pytest

from pulsebook.llm import pieces
from pulsebook.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(pieces.public_model())


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.public_model())


def odd_texts(library):
    rng = random.Random(11)
    parts = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts = ["", " ", "  a", "a  ", " \n ", "▁", "▁▁a▁", "a" * 5000, "x\0y", "漢字かな交じり文", "🙂🙂 😀é", "<0x0A>", "<s>", "</s> <unk>", "�", "\U0010ffff"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(2000)]
    texts += ["".join(rng.choices("abt he", k=rng.randint(1, 300))) for _ in range(2000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz  \n.,=-_#019éüß", k=rng.randint(1, 200))) for _ in range(2000)]
    scripts = [(0, 0x24F), (0x370, 0x600), (0x4E00, 0x9FFF), (0x1F300, 0x1F700)]
    texts += ["".join(chr(rng.randint(*rng.choice(scripts))) for _ in range(rng.randint(1, 80))) for _ in range(1000)]
    return texts + ["".join(rng.choices("abcdefghijABCDEFGHIJ0123456789+/", k=20000))]


def test_ids_and_texts_of_the_library(own, library):
    texts = odd_texts(library)
    ids, sizes = own.encode(texts)
    back = own.decode(ids, sizes)
    at = 0
    for text, size, read in zip(texts, sizes, back):
        want = library.encode(text)
        assert ids[at : at + size].tolist() == want and read == library.decode(want)
        at += size


def test_any_ids_decode_as_in_the_library(own, library):
    rng = random.Random(12)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 2), rng.randint(3, 258), rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int64), np.array([len(ids)])) == [library.decode(ids)]


def test_a_better_pair_made_by_a_merge_comes_first(library):
    # One merge at a time, the best pair first and the leftmost of equals: what the rounds must equal for any ranks.
    rng = random.Random(13)
    for _ in range(300):
        letters = "abc"
        texts = list(letters) + ["".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(12)]
        texts = list(dict.fromkeys(texts))
        order = rng.sample(range(len(texts)), len(texts))
        rank = dict(zip(texts, order))
        own = object.__new__(pieces.Pieces)
        own.size, own.stride = len(texts), 1000
        pairs = {texts.index(t[:i]) * 1000 + texts.index(t[i:]): t for t in texts for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank}
        if not pairs:
            continue
        own.keys = np.array(sorted(pairs), np.int64)
        own.joined = np.array([texts.index(pairs[k]) for k in sorted(pairs)], np.int32)
        own.ranks = np.array([rank[pairs[k]] for k in sorted(pairs)], np.int32)
        words = ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(20)]
        got, counts = own.merged(np.array([texts.index(c) for w in words for c in w], np.int32), np.array([len(w) for w in words]))
        want = []
        for word in words:
            now = list(word)
            while found := min(((rank[a + b], i) for i, (a, b) in enumerate(zip(now, now[1:])) if a + b in rank), default=None):
                now[found[1] : found[1] + 2] = [now[found[1]] + now[found[1] + 1]]
            want.append(now)
        assert [texts[i] for i in got.tolist()] == [t for w in want for t in w] and counts.tolist() == [len(w) for w in want]


def test_long_texts_are_cut_between_words_only(own, library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 50)
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    text = "Many short words, and   one " + "verylong" * 40 + " word.\n\nThen others " * 5
    ids, sizes = own.encode([text, "", text])
    want = library.encode(text)
    assert ids.tolist() == want + want and sizes.tolist() == [len(want), 0, len(want)]
    assert own.decode(ids, sizes) == [text, "", text]


def test_frames(docs, nothing, library):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    out = pieces.encode(docs, read_back=True)
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns == ["key", "ids", "decoded"]
    assert all(r.ids == library.encode(texts[r.key]) and r.decoded == texts[r.key] for r in rows)
    assert {r.text for r in pieces.decode(out).collect()} == set(texts.values())
    assert pieces.encode(nothing, read_back=True).count() == 0 and pieces.decode(pieces.encode(nothing)).count() == 0


def test_lists_with_nulls(spark, library):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [None, 15043, None])], "key long, ids array<int>")
    assert sorted(map(tuple, pieces.decode(frame).collect())) == [(1, ""), (2, ""), (3, library.decode([15043]))]


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        pieces.Pieces(str(path))


def test_query(spark, library):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert {tuple(r) for r in QUERIES["op11_sentencepiece"](spark, FOLDER).collect()} == want
