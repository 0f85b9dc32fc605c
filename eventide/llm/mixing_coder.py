"""Context-mixing range coder for token ids (numpy, many blocks in lock step).

Each block is coded on its own from a reset model, so blocks can be coded and
decoded in any order and side by side.  Inside a block an id goes by its number
among the block's ids.  For every id three predictions are at hand: the id that
last followed the two ids before it (order 2), the id that last followed the id
before it (order 1), each with a confidence, and the frequencies of the ids that
neither names (order 0).  The probabilities that order 2 is right, that order 1
is right or that order 0 must name the id are learned per block for each joint
confidence; that choice is range-coded, and an id left to order 0 follows by its
frequency.

All arithmetic is on integers, so any machine decodes what any other wrote.
Payload: two 16-bit sizes, the packed head (ids of the block as differences,
their order-0 counts, probabilities of the choices), the coder's 32-bit words.  A
block's checksum is the CRC-32 of its ids as little-endian 32-bit integers and is
verified on decoding.  Ids are below 65,536 (a larger one is refused on encoding)
and blocks hold at most 8,192 of them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 8192
LANES = 1024        # blocks coded side by side; a worker's memory follows it
SLOT_BITS = 11      # slots of order 2 in each block
SURE = 5            # highest confidence
CHUNK = 128         # steps whose intervals are looked up at once
_CONTEXTS = 128     # confidence of order 2, that of order 1 (3 bits each), whether they agree
_NEW = 1 << 16
_U = np.uint64
_TOTAL_BITS = 8     # of a choice's probabilities


def _fixed(x: int, kind=np.uint64):
    """A constant as an array, which numpy takes in faster than a scalar."""
    return np.array(x, kind)


_ONE, _WORD, _LOW = _fixed(1), _fixed(1 << 32), _fixed((1 << 32) - 1)
_BITS, _HALF, _FIVE, _SIXTEEN, _LOWER = (_fixed(x) for x in (_TOTAL_BITS, 32, 5, 16, 0xFFFF))
_ONE16, _THREE16, _SIX16, _SEVEN16, _EIGHT16 = (_fixed(x, np.uint16) for x in (1, 3, 6, 7, 8))
_MIX_X, _MIX_P, _SLOT_SHIFT = (_fixed(x, np.uint32) for x in (0x9E3779B1, 0x85EBCA77, 32 - SLOT_BITS))
# by 2 * confidence + hit: whether an entry is kept, and its change (modulo 2**16)
_KEEP = np.array([0, 0xFFFF, 0, 0xFFFF] + [0xFFFF] * 12, np.uint16)
_CHANGE = np.array([0, 1, 0, 1] + [d & 0xFFFF for c in range(2, 8) for d in ((c >> 1) - c, int(c < SURE))], np.uint16)


class _Model:
    """Tables of orders 1 and 2 of all lanes; every lane is one block.

    An entry is number << 3 | confidence; all lanes' order-2 entries precede the order-1 entries.
    """

    def __init__(self, lanes: int, width: int):
        self.entries = np.zeros((lanes << SLOT_BITS) + lanes * width, np.uint16)
        self.base = np.stack((np.arange(lanes) << SLOT_BITS, (lanes << SLOT_BITS) + np.arange(lanes) * width))
        self.slot = self.base.copy()
        self.mixed = np.zeros(lanes, np.uint32)      # order 1's part of the next order-2 slot

    def keep(self, k: int):
        """Goes on with the first k lanes only."""
        self.base, self.slot = self.base[:, :k].copy(), self.slot[:, :k].copy()
        self.mixed = self.mixed[:k].copy()

    def predict(self):
        """Context of the choice; the candidates stay in a and b."""
        self.e = self.entries.take(self.slot)
        self.sure = self.e & _SEVEN16
        self.a, self.b = self.e >> _THREE16
        row = self.sure[0] << _THREE16
        row |= self.sure[1]
        row |= (self.a == self.b) << _SIX16
        return row

    def update(self, x: np.ndarray):
        """Enters the ids that came (numbers)."""
        fresh = x << _THREE16
        fresh |= _ONE16
        e = self.e ^ fresh
        at = self.sure << _ONE16
        at |= e < _EIGHT16
        at = at.astype(np.int64)
        e &= _KEEP.take(at)
        e ^= fresh
        e += _CHANGE.take(at)
        self.entries[self.slot] = e
        wide = x.astype(np.uint32)
        h = wide * _MIX_X
        h += self.mixed
        h >>= _SLOT_SHIFT
        np.add(self.base[0], h, out=self.slot[0])
        np.add(self.base[1], x, out=self.slot[1])
        np.multiply(wide, _MIX_P, out=self.mixed)


def _groups(sizes: np.ndarray):
    """Lanes of at most LANES blocks, the longest first."""
    order = np.argsort(-sizes, kind="stable")
    for part in np.array_split(order, -(-len(order) // LANES)) if len(order) else ():
        yield part


def _runs(sizes: np.ndarray):
    """(first step, end, lanes) of the steps that the same lanes have; sizes fall."""
    at = 0
    for end in np.unique(sizes).tolist():
        if end > at:
            yield at, end, int(np.searchsorted(-sizes, -end, side="right"))
            at = end


def encode(blocks: list[np.ndarray]) -> list[tuple[bytes, int]]:
    """(payload, checksum) of each block of ids."""
    out: list = [None] * len(blocks)
    for group in _groups(np.array([len(b) for b in blocks], np.int64)):
        for i, payload in zip(group, _encode([blocks[i] for i in group])):
            out[i] = (payload, zlib.crc32(np.ascontiguousarray(blocks[i], "<u4")))
    return out


def _numbered(blocks, longest):
    """The ids of each block, ascending, and every id's number among them as (step, lane)."""
    rows, tables = np.zeros((len(blocks), longest), np.uint16), []
    number, there = np.zeros(_NEW, np.uint16), np.zeros(_NEW, bool)
    for i, b in enumerate(blocks):
        if len(b) and int(np.max(b)) >= _NEW:
            raise ValueError(f"id {int(np.max(b))} is not below {_NEW}")
        there[b] = True
        eights = np.flatnonzero(there.view(np.uint64))
        ids = (eights[:, None] * 8 + np.arange(8))[there.reshape(-1, 8)[eights]]
        there[ids] = False
        number[ids] = np.arange(len(ids))
        rows[i, : len(b)] = number[b]
        tables.append(ids)
    return tables, np.ascontiguousarray(rows.T)


def _bounds(seen: np.ndarray) -> np.ndarray:
    """First and second bound of the choices of every row, of 256, from the rows' counts; none is without a share."""
    total = np.maximum(seen.sum(axis=1), 1)
    room = (1 << _TOTAL_BITS) - 3
    share = 1 + seen[:, :2] * room // total[:, None]
    return np.cumsum(share, axis=1)


def _encode(blocks):
    n, longest = len(blocks), len(blocks[0]) if blocks else 0
    sizes = np.array([len(b) for b in blocks], np.int64)
    tables, ids = _numbered(blocks, longest)
    width = max(map(len, tables), default=0) + 1

    # what the model says of every id
    m = _Model(n, width)
    contexts, picks = np.zeros((longest, n), np.uint8), np.full((longest, n), 3, np.uint8)
    for lo, hi, k in _runs(sizes):
        m.keep(k)
        for t in range(lo, hi):
            x = ids[t, :k]
            contexts[t, :k] = m.predict()
            not_a = m.a != x
            np.add(not_a, not_a & (m.b != x), out=picks[t, :k], dtype=np.uint8)
            m.update(x)

    # what the block's head holds
    seen, counts = np.zeros(n * _CONTEXTS * 4, np.int64), np.zeros(n * width, np.int64)
    first, row0 = np.arange(n, dtype=np.int32) * width, np.arange(n, dtype=np.int32) * (4 * _CONTEXTS)
    for lo in range(0, longest, 8 * CHUNK):
        hi = lo + 8 * CHUNK
        p = picks[lo: hi]
        seen += np.bincount((row0 + contexts[lo: hi] * np.int32(4) + p).ravel(), minlength=len(seen))
        counts += np.bincount((ids[lo: hi] + first)[p == 2], minlength=len(counts))
    seen = seen.reshape(-1, 4)
    seen[:, 3] = 0
    bounds = _bounds(seen)
    used = seen.any(axis=1)
    counts = counts.reshape(n, width)
    below = np.cumsum(counts, axis=1) - counts
    total = np.maximum(counts.sum(axis=1), 1)
    heads = [_head(tables[i], counts[i], bounds[s], used[s])
             for i, s in ((i, slice(i * _CONTEXTS, (i + 1) * _CONTEXTS)) for i in range(n))]
    starts = np.zeros((len(bounds), 5), np.uint32)
    starts[:, 1:3], starts[:, 3:] = bounds, 1 << _TOTAL_BITS
    shares = (starts[:, :4] << 16 | np.diff(starts, axis=1)).ravel()           # start and width of each choice

    # the intervals, one inside the other
    cap = longest + 4
    out = np.zeros(n * cap, np.uint64)
    at0 = np.arange(n) * cap
    at = at0 + 1
    low, size = np.zeros(n, _U), np.full(n, (1 << 64) - 1, _U)
    all_low, all_at = low, at
    spans = (below << 16 | counts).astype(np.uint32).ravel()
    total = total.astype(np.uint64)
    for first_step, end, k in _runs(sizes):
        low, size, at = low[:k], size[:k], at[:k]
        for lo in range(first_step, end, CHUNK):
            hi = min(lo + CHUNK, end)
            p = picks[lo: hi, :k]
            zero = p == 2
            share = shares.take(row0[:k] + contexts[lo: hi, :k] * np.int32(4) + p).astype(np.uint64)
            start = share >> _SIXTEEN
            share &= _LOWER
            freq = np.where(zero, spans.take(first[:k] + ids[lo: hi, :k]), np.uint32(1)).astype(np.uint64)
            under = freq >> _SIXTEEN
            freq &= _LOWER
            of = np.where(zero, total[:k], _ONE)
            for t in range(hi - lo):
                step = size >> _BITS
                more = step * start[t]
                step *= share[t]
                step //= of[t]
                more += step * under[t]
                more += low
                carry = more < low
                if carry.any():
                    out[at[carry] - 1] += _ONE
                step *= freq[t]
                out[at] = more >> _HALF
                small = step < _WORD
                at += small
                shift = small << _FIVE
                np.left_shift(more, shift, out=low)
                np.left_shift(step, shift, out=size)
    out[all_at] = all_low >> _HALF
    out[all_at + 1] = all_low & _LOW
    out = out.reshape(n, cap)
    ends = all_at + 2 - at0
    used = int(ends.max(initial=0))
    for lo in range(0, n, 64):
        part = out[lo: lo + 64, :used]
        while (over := part >> _HALF).any():
            part &= _LOW
            part[:, :-1] += over[:, 1:]
    return [heads[i] + out[i, 1: e].astype("<u4").tobytes() for i, e in enumerate(ends.tolist())]


def _planes(a: np.ndarray) -> bytes:
    return (a & 255).astype(np.uint8).tobytes() + (a >> 8).astype(np.uint8).tobytes()


def _head(ids, counts, bounds, used) -> bytes:
    probabilities = np.where(used[:, None], bounds, 0).astype(np.uint8).T.tobytes()
    packer = zlib.compressobj(1, zlib.DEFLATED, strategy=zlib.Z_RLE)
    body = packer.compress(_planes(np.diff(ids, prepend=0)) + _planes(counts[: len(ids)]) + probabilities) + packer.flush()
    return struct.pack("<HH", len(ids), len(body)) + body


def _read_head(payload: bytes):
    """(ids, counts, both bounds, words) of a payload."""
    try:
        n, size = struct.unpack_from("<HH", payload)
        body = np.frombuffer(zlib.decompress(payload[4: 4 + size]), np.uint8)
    except (zlib.error, struct.error) as e:
        raise ValueError(f"a block's head is damaged: {e}") from e
    words = payload[4 + size:]
    if len(body) != 4 * n + 2 * _CONTEXTS or len(words) % 4:
        raise ValueError("a block's head is damaged")
    part = body[: 4 * n].reshape(4, n).astype(np.int64)
    return np.cumsum(part[0] | part[1] << 8), part[2] | part[3] << 8, body[4 * n:].reshape(2, -1), words


def decode(payloads: list[bytes], sizes: list[int], checksums: list[int]) -> list[np.ndarray]:
    """The ids of each block; raises on a checksum that does not hold."""
    sizes = np.asarray(sizes, np.int64)
    out: list = [None] * len(payloads)
    for group in _groups(sizes):
        for i, ids in zip(group, _decode([payloads[i] for i in group], sizes[group])):
            if zlib.crc32(ids.astype("<u4")) != checksums[i]:
                raise ValueError(f"checksum of block {i} does not hold")
            out[i] = ids
    return out


def _decode(payloads, sizes):
    n, longest = len(payloads), int(sizes[0]) if len(sizes) else 0
    heads = [_read_head(p) for p in payloads]
    words = np.frombuffer(b"".join(h[3] for h in heads) + bytes(8), "<u4").astype(np.uint64)
    length = np.array([len(h[3]) // 4 for h in heads], np.int64)
    at = np.cumsum(length) - length
    width = max((len(h[0]) for h in heads), default=0) + 1
    # order 0: the number at every place of a block's counts; below and count of every number
    totals = np.array([int(h[1].sum()) for h in heads], np.int64)
    if (totals > BLOCK_IDS).any():
        raise ValueError("a block's head is damaged")
    first = np.arange(n) * width
    places = np.zeros(int(totals.sum()) + 1, np.uint16)
    place0 = np.cumsum(totals) - totals
    spans = np.zeros(n * width, np.uint32)
    bounds = np.empty(n * _CONTEXTS, np.uint64)
    for i, (ids, counts, b, _) in enumerate(heads):
        places[place0[i]: place0[i] + totals[i]] = np.repeat(np.arange(len(ids)), counts)
        spans[first[i]: first[i] + len(ids)] = (np.cumsum(counts) - counts) << 16 | counts
        bounds[i * _CONTEXTS: (i + 1) * _CONTEXTS] = b[0].astype(np.uint64) | b[1].astype(np.uint64) << _HALF
    totals = np.maximum(totals, 1).astype(np.uint64)

    m = _Model(n, width)
    out = np.zeros((longest, n), np.uint16)
    code = words.take(at, mode="clip") << _HALF | words.take(at + 1, mode="clip")
    at += 2
    size = np.full(n, (1 << 64) - 1, _U)
    for lo, hi, k in _runs(sizes):
        m.keep(k)
        code, size, at, place0, first, totals = (v[:k] for v in (code, size, at, place0, first, totals))
        last, row0 = totals - _ONE, np.arange(k) * _CONTEXTS
        for t in range(lo, hi):
            t1 = bounds.take(m.predict() + row0)
            t2 = t1 >> _HALF
            t1 &= _LOW
            step = size >> _BITS
            t1 *= step
            t2 *= step
            not2, zero = code >= t1, code >= t2
            end = np.where(not2, t2, t1)
            t1 *= not2                                              # start of the chosen interval, if not order 0
            step <<= _BITS
            np.copyto(end, step, where=zero)
            np.copyto(t1, t2, where=zero)
            code -= t1
            end -= t1
            end //= np.where(zero, totals, _ONE)
            place = np.minimum(code // end, last).view(np.int64)
            place += place0
            x = places.take(place, mode="clip")
            span = spans.take(first + x).astype(np.uint64)
            under = span >> _SIXTEEN
            under *= zero
            under *= end
            code -= under
            span &= _LOWER
            end *= np.where(zero, span, _ONE)
            x = np.where(zero, x, np.where(not2, m.b, m.a))
            out[t, :k] = x
            small = end < _WORD
            shift = small << _FIVE
            np.left_shift(end, shift, out=size)
            code <<= shift
            code |= words.take(at, mode="clip") * small
            at += small
            m.update(x)
    rows = np.ascontiguousarray(out.T)
    return [h[0].take(rows[i, :s], mode="clip").astype(np.uint32) if s else np.zeros(0, np.uint32)
            for i, (h, s) in enumerate(zip(heads, sizes.tolist()))]
