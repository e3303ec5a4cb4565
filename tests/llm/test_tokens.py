"""Encoding, wavelet files and packing against the library and plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from molcount.llm import encoding, packing, tokenfiles, wavelet
from molcount.llm.common import Scratch
from molcount.llm.encoding import default_path, encoder


@pytest.fixture(scope="module")
def ids(rows):
    t = Tokenizer.from_file(default_path())
    return [t.encode(r[1] or "", add_special_tokens=False).ids for r in rows]


def crc(x):
    return zlib.crc32(np.array(x, dtype="<u4").tobytes())


def test_pieces_encode_like_whole_texts(rows, ids):
    texts = [r[1] or "" for r in rows] + [" a", "a ", "\n", "\na\nb c", " \ta  b", "don't <|endoftext|> 's", "a\x00b c", "a b\n\nc  d"]
    e = encoder(default_path())
    assert e.encode(texts) == [x.tobytes() for x in e.whole(texts)]
    assert e.encode(texts[: len(ids)]) == [np.array(x, dtype="<u4").tobytes() for x in ids]


def test_marks_of_special_tokens_are_theirs():
    assert np.frombuffer(encoder(default_path()).encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("held", [30, 1_000_000])
def test_any_mixture_of_marks_encodes_like_the_library(monkeypatch, held):
    import random

    monkeypatch.setattr(encoding, "CACHE", held)
    monkeypatch.setattr(encoding, "SEGMENT", 40)
    marks = [*"ab ,'s1\n\t \r\x0b\xe9\xbd\xab\u0301\u6771\u2014\u2003\xa0\x1f\x85", "<|endoftext|>", "ing", " the", "\n\n", "x" * 30]
    random.seed(3)
    texts = ["".join(random.choices(marks[: random.choice([8, 12, len(marks)])], k=random.randint(1, 60))) for _ in range(4000)]
    texts += [f"a{chr(c)}b c{chr(c)} {chr(c)}d" for c in range(0x250)]
    e = encoding.Encoder(default_path())
    assert e.encode(texts) == [x.tobytes() for x in e.whole(texts)]
    assert e.known <= held


def test_wavelet_access_rank_and_select():
    x = np.random.default_rng(1).zipf(1.4, 150_000) % 50_257
    s = wavelet.Shard(wavelet.build(x, [5, None], [100, 149_900], 16))
    assert (s.decode() == x).all() and s.doc_ids == [5, None]
    assert all(s.token(i) == x[i] for i in (0, 1, 131_071, 131_072, 149_999))
    for token in (1, 2, 77):
        at = np.flatnonzero(x == token)
        assert s.count(token) == len(at) and s.count(token, 5000) == (at < 5000).sum()
        assert [s.find(token, k) for k in (0, len(at) - 1)] == [at[0], at[-1]]
    assert s.count(50_000) == (x == 50_000).sum() and s.count(1 << 17) == 0
    with pytest.raises(IndexError):
        s.find(1, 10**6)
    assert wavelet.Shard(wavelet.build(np.array([], dtype=np.uint32), [], [], 16)).decode().size == 0


def test_files_hold_all_documents_in_order(spark, docs, rows, ids):
    got = sorted(tokenfiles.write_and_read(spark, docs).collect(), key=lambda r: r["start"])
    key = lambda r: (r[0] is None, r[0] or 0)
    assert [r["doc_id"] for r in got] == [r[0] for r in sorted(rows, key=key)]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((r[0], len(x) + 1, crc([*x, 2])) for r, x in zip(rows, ids, strict=True))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()


def test_small_shards_and_empty_tables(spark, docs, empty, rows):
    s = Scratch(spark, "t")
    m = s.keep(tokenfiles.write(docs, f"{s.root}/files", shard_tokens=50), "m").collect()
    assert sum(r["docs"] for r in m) == len(rows) and len(m) > 10
    assert tokenfiles.write_and_read(spark, empty).count() == 0


def check_pieces(got, rows, ids, width=1024):
    docs = defaultdict(list)
    for r in got:
        docs[r["doc_id"], r["doc_tokens"]].append(r)
    want = Counter()
    for r, x in zip(rows, ids, strict=True):
        want[r[0], len(x) + 1] += 1
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, n in want.items():
        assert sum(r["length"] for r in docs[k]) == n * k[1]
    by_id = defaultdict(list)
    for r, x in zip(rows, ids, strict=True):
        by_id[r[0]].append([*x, 0])
    for r in got:
        assert any(len(x) == r["doc_tokens"] and crc(x[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for x in by_id[r["doc_id"]])
    pad = 0
    for v in seqs.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= width
        pad += 0 if at & (at - 1) == 0 else width - at
    assert sorted(seqs) == list(range(len(seqs)))
    return pad


def test_pieces_cover_every_id_once_with_little_padding(spark, docs, empty, rows, ids):
    got = packing.pack(spark, docs).collect()
    total = sum(len(x) + 1 for x in ids)
    assert check_pieces(got, rows, ids) <= 0.02 * total
    assert packing.pack(spark, empty).count() == 0


@pytest.mark.parametrize("demand", [{600: 5000}, {700: 300, 324: 299, 100: 50}, {k: 7 for k in range(1, 1024, 5)}, {1: 3}, {}])
def test_table_gives_each_item_a_place(demand):
    places, first, tokens, end = packing.table(demand, 1024, 10)
    used = defaultdict(list)
    for k, n in demand.items():
        for rank in range(n):
            t = places[k]
            lo, seq, off, copies = t[int(np.searchsorted(t[:, 0], rank, side="right")) - 1].tolist()
            if copies:
                used[seq + (rank - lo) // copies].append((off + (rank - lo) % copies * k, k))
            else:
                for s, o, m in packing.lane_cuts(off + (rank - lo) * k, k, tokens, 1024):
                    used[first + s].append((o, m))
    pad = 0
    for v in used.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        pad += 0 if at & (at - 1) == 0 else 1024 - at
    assert sorted(used) == list(range(10, end)) and pad <= 0.02 * sum(k * n for k, n in demand.items())
