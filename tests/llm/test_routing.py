"""Blocks of hashes on their way to very many buckets."""

import time

import numpy as np
import pytest

from brindle.llm import meeting, repeats, suffix

from test_operators import REMOVE, SHARED, check_removed, docs, none  # noqa: F401


@pytest.mark.parametrize("remove, size, by_word", [REMOVE[1], REMOVE[2]])
def test_two_steps_give_the_same(docs, none, monkeypatch, remove, size, by_word):  # noqa: F811
    """Five bits in two steps, blocks so small that entries of many are put together anew."""
    monkeypatch.setattr(meeting, "DIRECT", 3)
    for module in (meeting, suffix, repeats):
        if hasattr(module, "BLOCK"):
            monkeypatch.setattr(module, "BLOCK", 200)
    check_removed(remove, size, by_word, [r.text for r in docs.select("text").collect()], remove(docs))
    assert remove(none).count() == 0


def sized(rows):
    """Bytes, with what Spark adds to a row of nine columns."""
    return sum(88 + sum(len(v) + 4 for v in r.values() if isinstance(v, bytes)) for r in rows)


def random_block(rng, n, top, blocks=1):
    """Entries whose hashes share their first bits, of documents in so many blocks."""
    hash_ = rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
    hash_ = hash_ >> np.uint64(top)
    return meeting.Entries(rng.integers(0, blocks, n) << 32 | rng.integers(0, 500, n), hash_, np.zeros(n, np.uint64), rng.integers(0, 1 << 20, n), np.ones(n, np.uint8))


def test_bytes_and_seconds_of_an_entry_dont_grow_with_the_buckets():
    """From 2^12 buckets, cut at once, to 2^20 and 2^24, cut by half the bits, put together and cut by all."""
    rng, n, found = np.random.default_rng(1), meeting.BLOCK, {}
    for bits in (12, 20, 24):
        first = bits if bits <= meeting.DIRECT else (bits + 1) // 2
        start = time.process_time()
        rows = [meeting.packed(b, 1, part) for b, part in meeting.cut(random_block(rng, n, 0), first)]
        steps = [(sized(rows) / n, len(rows))]
        if first < bits:
            # as many blocks as give this one its entries
            blocks = 1 << first
            rows = [meeting.repacked(b, np.arange(blocks), part) for b, part in meeting.cut(random_block(rng, n, first, blocks), bits)]
            steps.append((sized(rows) / n, len(rows)))
        found[bits] = steps, (time.process_time() - start) / len(steps)
    for steps, seconds in found.values():
        assert all(size <= 1.5 * found[12][0][0][0] and count <= 1 << meeting.DIRECT for size, count in steps), found
        assert seconds < 3 * found[12][1], found


def test_rows_of_several_blocks_come_back():
    rng = np.random.default_rng(2)
    e, known, back = random_block(rng, 5_000, 4, 40), rng.integers(-(1 << 62), 1 << 62, 40), []
    for bucket, part in meeting.cut(e, 10):
        numbers = [7]  # of a row before
        got = meeting.unpacked(meeting.repacked(bucket, known, part), numbers)
        back += zip(np.array(numbers)[got.ref >> 32].tolist(), (got.ref & 0xFFFFFFFF).tolist(), got.hash.tolist(), got.value.tolist(), got.flag.tolist(), strict=True)
    assert sorted(back) == sorted(zip(known[e.ref >> 32].tolist(), (e.ref & 0xFFFFFFFF).tolist(), e.hash.tolist(), e.value.tolist(), e.flag.tolist(), strict=True))
