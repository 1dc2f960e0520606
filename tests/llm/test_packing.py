import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from helpers import AWKWARD, SCHEMA, frame, table
from tokenizers import Tokenizer

from stillhouse.llm import packing
from stillhouse.llm.queries import op10_best_fit_packing


def plain_bins(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    rooms, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        bins += at == len(rooms)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - n)
    return bins


def check_layout(rows, capacity=2048):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_sequence) == plain_bins([r.length for r in rows], capacity)


def check_pieces(rows, docs, capacity=2048):
    tokenizer, cut = Tokenizer.from_file(packing.default_tokenizer()), defaultdict(list)
    for r in rows:
        cut[r.doc_id].append(r)
    assert set(cut) == {d[0] for d in docs}
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want = [(i, s, len(ids[s:s + capacity]), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes())) for i, s in enumerate(range(0, len(ids), capacity))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in cut[doc_id]) == want


def test_query(spark, small, docs):
    rows = op10_best_fit_packing(spark, small).collect()
    check_pieces(rows, [(d[0], d[1]) for d in docs])
    check_layout(rows)


def test_stretches_keep_the_bounds_of_empty_texts(monkeypatch):
    tokenizer, texts = Tokenizer.from_file(packing.default_tokenizer()), [None, "", "one two", " \n ", "two", None, "é x, x", ""]
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() + packing.END for t in texts]
    for stretch in (1, 5, packing.STRETCH):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        for array, expected in ((pa.array(texts, pa.string()), want), (pa.array(texts, pa.string())[2:], want[2:]), (pa.array([None, ""], pa.string()), want[:2])):
            assert list(packing.WordEncoder(packing.default_tokenizer()).encode_all(array)) == expected


def test_words_encode_like_whole_texts(docs):
    tokenizer, encoder = Tokenizer.from_file(packing.default_tokenizer()), packing.WordEncoder(packing.default_tokenizer())
    odd = ["it's  I'm x\x85y", "á ́b éÉ", "1234 ４２ <|endoftext|> x<|startoftext|>", "İSTANBUL ΣΑΣ ς", " 　中文 字", "\x1c \x1d", "👩‍👩‍👧 é"]
    for text in odd + [d[1] for d in docs[:60]]:
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_plan_equals_best_fit_decreasing():
    random.seed(11)
    for _ in range(200):
        capacity = random.choice([10, 64, 2048])
        counts = {random.randint(1, capacity): random.randint(1, 200) for _ in range(random.randint(1, 30))}
        segments, opened = packing.plan(counts, capacity)
        assert opened == plain_bins([n for n, c in counts.items() for _ in range(c)], capacity)
        assert sum(1 for _ in segments) <= 3 * capacity * capacity.bit_length()
    segments, opened = packing.plan({2048: 10**12, 3: 5 * 10**13, 1: 7}, 2048)
    assert len(segments) < 20 and opened == 10**12 + -(-(5 * 10**13) // 682)


def test_awkward_rows(spark, tmp_path):
    rows = op10_best_fit_packing(spark, table(spark, tmp_path, AWKWARD)).collect()
    check_layout(rows)
    once = {r[0]: r[1] for r in AWKWARD}
    assert sum(r.doc_id == 6 for r in rows) == 2
    check_pieces([r for r in rows if r.doc_id != 6], [(k, v) for k, v in once.items() if k != 6])
    assert [r.length for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert op10_best_fit_packing(spark, table(spark, tmp_path / "none", [])).collect() == []


def test_sequences_hold_the_ids(spark):
    rows = [(*r, "s", 0) for r in AWKWARD]
    packed = packing.pack(frame(spark, rows, SCHEMA + ", piece string, length int"), with_ids=True)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_words_go_to_the_tokenizer_together_and_without_final_signs(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(packing.default_tokenizer()), packing.WordEncoder(packing.default_tokenizer())
    alone = []
    monkeypatch.setattr(encoder, "_one", lambda word: alone.append(word) or np.array(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes())
    texts = ["Alpha### alpha%%% alpha. 12, x-1 a1*** déjà?! 日本語、 wort&&& 's's. --.. привет,", None, "", " \t\n", "x-1"]
    for text, ids in zip(texts, encoder.encode_all(pa.array(texts, pa.string()))):
        assert ids == np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert not alone and "alpha" in encoder.known
    assert encoder.encode("a|b | c") == np.array(tokenizer.encode("a|b | c", add_special_tokens=False).ids, "<u4").tobytes() and alone
