"""Token files and packing against the tokenizers library itself."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from repopulse.llm import packing, rans, token_files, tokens
from repopulse.llm.bin_completion import best_fit, lower_bound, pack_histogram, search
from repopulse.llm.common import table
from repopulse.llm.tokens import TextEncoder, vocabulary_path
from repopulse.session import scratch_path

from .conftest import AWKWARD, keyed

BYTE, WORD = (vocabulary_path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def plain_ids(tokenizer: Tokenizer, text: str | None) -> np.ndarray:
    return np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


@pytest.mark.parametrize("vocabulary", [BYTE, WORD])
def test_pieces_give_the_ids_of_the_whole_text(spark, vocabulary):
    tokenizer, encoder = Tokenizer.from_file(vocabulary), TextEncoder(vocabulary)
    texts = [t for _, t in AWKWARD if t]
    texts += ["a  b   c", "it's  we'll\n\n x", "x\n", "\n", " lead", "tab\there\r\n", "İ ΣΑΣ. ſ K 3.5²"]
    texts += [row.text for row in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    for text in texts:
        assert encoder.encode(text) == plain_ids(tokenizer, text).tobytes(), text[:80]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBé' .,!|\n\t1½́ ß", max_size=40))
def test_pieces_give_the_ids_of_any_text(text):
    for vocabulary in (BYTE, WORD):
        tokenizer, encoder = _pair(vocabulary)
        assert encoder.encode(text) == plain_ids(tokenizer, text).tobytes()


_pairs: dict = {}


def _pair(vocabulary):
    if vocabulary not in _pairs:
        _pairs[vocabulary] = Tokenizer.from_file(vocabulary), TextEncoder(vocabulary)
    return _pairs[vocabulary]


@pytest.mark.parametrize("vocabulary", [BYTE, WORD])
def test_texts_in_groups_give_the_ids_of_each(monkeypatch, vocabulary):
    monkeypatch.setattr(tokens, "GROUP_CHARACTERS", 300)
    tokenizer, encoder = _pair(vocabulary)
    texts = [t or "" for _, t in AWKWARD]
    texts += ["x\n\nY", "\nY", "a \n b", "end  ", " ", "Ünï×é,÷è.", "a <|endoftext|> b", "\x00a, b\x00"]
    texts += ["a\xa0 b", "a \xa0b", "c\n\u3000d", "e,\x85 f", "\ufeff g", "h =\u0338 i.", "j \u0301k", "日本 語"]
    found = list(encoder.encode_all(iter(texts)))
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert ids.tobytes() == plain_ids(tokenizer, text).tobytes(), text[:80]
    assert list(encoder.encode_all([])) == []


ODD = "aBé' .,!|\n\t1½\u0301 ß×\xa0\x85\x1c\u3000\u2028\u200b<=\u0338日\r&"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=ODD, max_size=25), max_size=6))
def test_groups_give_the_ids_of_any_texts(texts):
    for vocabulary in (BYTE, WORD):
        tokenizer, encoder = _pair(vocabulary)
        found = [ids.tobytes() for ids in encoder.encode_all(texts)]
        assert found == [plain_ids(tokenizer, text).tobytes() for text in texts]


def _counted(encoder):
    seen, work = Counter(), encoder._pieces._worked_out

    def counted(piece):
        seen[piece] += 1
        return work(piece)

    encoder._pieces._worked_out = counted
    return seen


def test_a_piece_is_worked_out_once_for_all_its_occurrences():
    encoder = TextEncoder(BYTE)
    seen = _counted(encoder)
    long = "x" * (tokens.LONGEST_CACHED + 1)  # is not kept, and still met once a group
    list(encoder.encode_all([f"One word, {long} one word, One word."] * 50))
    assert set(seen.values()) == {1} and {" word", ",", f" {long}"} <= set(seen)


def test_pieces_in_use_outlive_the_rare_ones(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    encoder = TextEncoder(BYTE)
    seen = _counted(encoder)
    for k in range(20):
        list(encoder.encode_all([f"used and {'a' * (k + 1)} {'b' * (k + 1)} {'c' * (k + 1)}"]))
    assert seen["used"] == seen[" and"] == 1
    assert len(encoder._pieces._young) + len(encoder._pieces._old) <= 2 * 15


def test_a_block_is_the_same_as_by_the_plain_steps():
    """The format holds: a block written by the definition reads back, and is what is written."""
    ids = np.random.default_rng(5).zipf(1.3, 700).clip(max=90).astype(np.uint32)
    model, lanes = rans.Model(rans.frequencies(np.bincount(ids))), 8
    states, words = [1 << 31] * lanes, []
    for k in range(len(ids) - 1, -1, -1):
        f, start = int(model.freq[ids[k]]), int(model.start[ids[k]])
        if k % lanes == min(lanes, len(ids) - k // lanes * lanes) - 1:
            words.insert(0, [])  # a step's words stand in the order of its lanes
        x = states[k % lanes]
        if x >= f << (63 - rans.PRECISION):
            words[0].insert(0, x & 0xFFFFFFFF)
            x >>= 32
        states[k % lanes] = (x // f << rans.PRECISION) + x % f + start
    flat = list(itertools.chain(*words))
    block = rans.encode_block(ids, model, lanes, every=1000)
    body = b"\0\0\0\0" + np.array(states, "<u8").tobytes() + np.array(flat, "<u4").tobytes()
    assert block[rans._HEAD.size : -4] == body and flat
    assert (rans.decode_block(block, model) == ids).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=900), st.integers(1, 9), st.integers(1, 5))
def test_blocks_decode_to_what_was_coded(ids, lanes, every):
    ids = np.array(ids, dtype=np.uint32)
    model = rans.Model(rans.frequencies(np.bincount(ids, minlength=301)))
    block = rans.encode_block(ids, model, lanes, every)
    assert (rans.decode_block(block, model) == ids).all()
    # Every checkpoint decodes alone.
    used = max(1, min(lanes, len(ids)))
    for k, at in enumerate(range(0, len(ids), every * used)):
        assert (rans.decode_part(block, model, k) == ids[at : at + every * used]).all()


def test_frequencies_keep_rare_symbols_and_sum_up():
    counts = np.ones(50_000, dtype=np.int64)
    counts[7] = 10**12
    counts[9] = 0
    freq = rans.frequencies(counts)
    assert freq.sum() == 1 << rans.PRECISION and freq[9] == 0 and freq[counts > 0].min() >= 1


def test_a_damaged_block_is_refused():
    ids = np.arange(1000, dtype=np.uint32) % 17
    model = rans.Model(rans.frequencies(np.bincount(ids)))
    block = bytearray(rans.encode_block(ids, model))
    block[len(block) // 2] ^= 1
    with pytest.raises(rans.DamagedBlock):
        rans.decode_block(bytes(block), model)


def expected_rows(rows, end):
    tokenizer, at, out = Tokenizer.from_file(BYTE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.append(plain_ids(tokenizer, text), np.uint32(end)).astype("<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    return out


def test_files_give_back_every_document(spark, awkward):
    path = scratch_path(spark, "files")
    token_files.write_token_files(awkward, path, BYTE, end_id=2, block_tokens=3000)
    read = token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "ids"
    )
    expected = expected_rows(AWKWARD, 2)
    assert keyed((r[0], r[1], r[2], r[3], bytes(r[4])) for r in read.collect()) == keyed(expected)
    assert spark.read.parquet(f"{path}/blocks").count() > 3


def test_files_of_an_empty_table(spark, nothing):
    path = scratch_path(spark, "files")
    token_files.write_token_files(nothing, path, BYTE, end_id=2)
    assert token_files.read_token_files(spark, path).count() == 0


def least_bins(lengths: list[int], capacity: int) -> int:
    """By trying: each piece into each open bin or a new one."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms) if room >= lengths[k]}.values():
            place(k + 1, [*rooms[:i], rooms[i] - lengths[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=0, max_size=9))
def test_bin_completion_packs_all_in_the_least_bins(lengths):
    lengths = sorted(lengths, reverse=True)
    packing_found = pack_histogram(dict(Counter(lengths)), 20)
    used = list(itertools.chain(*(pattern * times for pattern, times in packing_found)))
    assert sorted(used, reverse=True) == lengths
    assert all(sum(pattern) <= 20 for pattern, _ in packing_found)
    assert sum(times for _, times in packing_found) == (least_bins(lengths, 20) if lengths else 0)


def test_bin_completion_beats_best_fit_where_it_can():
    counts = {6: 2, 5: 2, 4: 2, 3: 2, 2: 1}  # two bins of 6+4 and two of 5+3+2, 5+3
    assert sum(t for _, t in pack_histogram(counts, 10)) == lower_bound(counts, 10) == 4
    assert sum(t for _, t in best_fit(counts, 10)) >= 4


def test_search_equals_trying_everything():
    chance = random.Random(11)
    cases = [(150, [74, 71, 69, 63, 54, 37, 33, 31])]
    for _ in range(1000):
        capacity, most = chance.randint(60, 200), chance.choice([40, 50, 60, 90])
        sizes = range(capacity // 10, capacity * most // 100)
        cases.append((capacity, chance.choices(sizes, k=chance.randint(6, 14))))
    for capacity, lengths in cases:
        found = search(dict(Counter(lengths)), capacity)
        used = itertools.chain(*(pattern * times for pattern, times in found.bins))
        assert sorted(used) == sorted(lengths)
        assert all(sum(pattern) <= capacity for pattern, _ in found.bins)
        assert found.bound <= found.used == sum(times for _, times in found.bins)
        assert found.proven
        assert found.used == least_bins(sorted(lengths, reverse=True), capacity), lengths


def test_a_search_cut_short_says_so_and_packs_all():
    chance = random.Random(2)
    counts = dict(Counter(chance.randrange(200, 500) for _ in range(1000)))
    found = search(counts, 1000, most_steps=1000)
    assert not found.proven and found.bound < found.used
    packed = Counter()
    for pattern, times in found.bins:
        packed.update({length: n * times for length, n in Counter(pattern).items()})
    assert packed == Counter(counts)
    many = search({length: 1 for length in range(1, 4097)}, 4096)  # every length there is
    assert sum(sum(p) * t for p, t in many.bins) == 4096 * 4097 // 2


def check_packing(pieces, docs, capacity):
    tokenizer, expected = Tokenizer.from_file(WORD), []
    for doc_id, text in docs:
        ids = np.append(plain_ids(tokenizer, text), np.uint32(1)).astype("<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert keyed(p[:5] for p in pieces) == keyed(expected)
    sequences: dict = {}
    for *_, length, _crc, sequence, offset in pieces:
        sequences.setdefault(sequence, []).append((offset, length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(p[3] for p in pieces)
    return len(sequences), -(-total // capacity)


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def test_packing_of_awkward_documents(spark, awkward, nothing):
    packed = packing.pack_documents(awkward, WORD, 1, capacity=64, with_ids=True)
    rows = [tuple(r) for r in packed.select(*COLUMNS).collect()]
    n, least = check_packing(rows, AWKWARD, 64)
    assert n <= least + 1
    whole = packing.sequences(packed).collect()
    assert len(whole) == n and all(len(r["ids"]) <= 64 * 4 for r in whole)
    by_sequence = Counter()
    for row in rows:
        by_sequence[row[5]] += row[3] * 4
    assert {r["sequence_id"]: len(r["ids"]) for r in whole} == dict(by_sequence)
    assert packing.pack_documents(nothing, WORD, 1).count() == 0


def test_packing_of_the_tables_reaches_the_bound(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    packed = packing.pack_documents(docs, WORD, 1)
    rows = [tuple(r) for r in packed.select(*COLUMNS).collect()]
    n, least = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)
    assert n == least
