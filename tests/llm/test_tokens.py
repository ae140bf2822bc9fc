import random
import zlib
from collections import defaultdict
from dataclasses import replace

import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, documents, prose
from tokenizers import Tokenizer

from sightline.llm import packing, tokens, wavelet

RULES = {"byte_bpe_50k.json": True, "word_bpe_49k.json": False}


def encoder(name):
    out = Tokenizer.from_file(public_tokenizers.path(name))  # as the library gives it
    return lambda text: out.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", RULES)
def test_pieces_give_the_ids_of_whole_texts(name):
    rng = random.Random(2)
    parts = ["a", "B", "'s", "'", " ", "  ", "\n", "\t", "é", "é", "́", "123", "!!", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "\xa0", "\x1c", "\x00", "ß", "Σ", "漢字", "🙂", "\r\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(6000)] + [prose(1, 200), *AWKWARD]
    own = tokens.PieceTokenizer(public_tokenizers.path(name), RULES[name], most=500)
    whole = encoder(name)
    for at in range(0, len(texts), 700):
        for text, ids in zip(texts[at : at + 700], own.encode(texts[at : at + 700]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)


def test_pieces_that_are_met_again_are_not_learnt_again(monkeypatch):
    own = tokens.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"), True, most=400)
    learnt, learn = [], own._learn

    def noted(new):
        learnt.extend(new)
        learn(new)

    monkeypatch.setattr(own, "_learn", noted)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i in range(30):
        text = " ".join(["often", "met", *(f"once{i}x{k}" for k in range(50))])
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(own.known) + len(own.older) <= 400 + 2 * 52
    assert learnt.count("met") == 1
    assert len(learnt) == len(set(learnt))


@pytest.mark.parametrize("name", RULES)
def test_cuts_before_stops_and_beside_white_space(name, monkeypatch):
    monkeypatch.setattr(tokens.PieceTokenizer, "GROUP", 300, raising=False)
    rng = random.Random(3)
    parts = ["ab", "é", "C", ".", ",", "...", "'s", "'", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "\u3000", "1", "\x00", "漢"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(6000)]
    own = tokens.PieceTokenizer(public_tokenizers.path(name), RULES[name], most=300)
    whole = encoder(name)
    for at in range(0, len(texts), 500):
        for text, ids in zip(texts[at : at + 500], own.encode(texts[at : at + 500]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)


def test_a_word_is_learnt_once_whatever_stop_follows(monkeypatch):
    own = tokens.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"), True)
    learnt, learn = [], own._learn
    monkeypatch.setattr(own, "_learn", lambda new: (learnt.extend(new), learn(new)))
    text = "so blicket, a blicket. A blicket\nor blicket... (blicket)"
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == encoder("byte_bpe_50k.json")(text)
    assert [x for x in learnt if "blicket" in x and "(" not in x] == ["blicket"]


def test_wide_white_space_does_not_make_the_rest_of_a_text_slow(monkeypatch):
    own = tokens.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"), True)
    monkeypatch.setattr(own, "_slow", None)
    text = " one  two.\n\nthree \n four five\t six "
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == encoder("byte_bpe_50k.json")(text)
    assert {"five\t six ", "\n one  two"} <= set(own.known)


def test_long_pieces_are_forgotten_sooner():
    own = tokens.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"), True, most=400)
    for i in range(20):
        own.encode([f"{i}x" + "ab1" * 2000])
    assert len(own.known) + len(own.older) < 10


def test_packing_round_trip(spark):
    rng = random.Random(4)
    texts = [prose(i, rng.choice([3, 40, 300, 2500])) for i in range(150)] + AWKWARD
    whole = encoder("word_bpe_49k.json")
    ids = {i + 1: [*whole(t), 1] for i, t in enumerate(texts)}
    docs = documents(spark, texts)
    p = packing.Packing(public_tokenizers.path("word_bpe_49k.json"), fan_in=2)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs.repartition(5), p).collect():
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for doc_id, own in pieces.items():
        assert [s for s, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) == len(ids[doc_id])
    assert set(pieces) == set(ids)
    used = []
    for own in sequences.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        used.append(sum(n for _, n in own))
    assert max(used) <= 2048
    assert sum(n < 2048 - p.least_cut for n in used) <= 3  # one tail for each two of five tasks
    assert packing.pack(docs.limit(0), p).collect() == []


def test_open_windows_are_bounded():
    p = packing.Packing("", windows=4)
    packer = packing.Packer(p)
    rng = random.Random(5)
    for i in range(500):
        packer.add(packing.Piece(i, 0, 0, bytes(4 * rng.randint(1, 1500))))
        assert len(packer.open) <= 4
    assert all(2048 - p.least_cut < sum(map(len, s)) <= 2048 for s in packer.taken())


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (5000, 50257), (3000, 7), (513, 70000)])
def test_wavelet_file(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    found = wavelet.WaveletFile(wavelet.encode(ids, [3, None] if n else [], np.array([n // 2, n] if n else [])))
    assert (found.ids() == ids).all()
    assert found.documents[0] == ([3, None] if n else [])
    for i in range(0, n, 97):
        token = int(ids[i])
        assert found.access(i) == token
        assert found.rank(token, i) == (ids[:i] == token).sum() and found.count(token) == (ids == token).sum()
        assert found.select(token, found.rank(token, i)) == i
    if n:
        assert list(found.locate(int(ids[0])))[:20] == np.flatnonzero(ids == ids[0]).tolist()[:20]
        assert found.count(1 << 20) == 0


def test_files_round_trip(spark, folder):
    texts = [prose(i, 30) for i in range(60)] + AWKWARD
    docs = documents(spark, texts)
    p = wavelet.TokenFiles(public_tokenizers.path("byte_bpe_50k.json"), partitions=3, file_ids=500)
    files = wavelet.write_files(docs.repartition(4), f"file://{folder}/ids", p)
    assert files.count() > 3
    whole = encoder("byte_bpe_50k.json")
    at, got = 0, {r["doc_id"]: r for r in wavelet.read_files(files).collect()}
    for i, text in enumerate(texts):
        own = [*whole(text), 0]
        assert tuple(got[i + 1]) == (i + 1, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)
    more = wavelet.write_files(docs, f"file://{folder}/more", replace(p, task_bytes=2000))
    assert files.select("task").distinct().count() <= 3 < more.select("task").distinct().count()
    assert {tuple(r) for r in wavelet.read_files(more).collect()} == {tuple(r) for r in got.values()}
    assert wavelet.read_files(wavelet.write_files(docs.limit(0), f"file://{folder}/none", p)).collect() == []
