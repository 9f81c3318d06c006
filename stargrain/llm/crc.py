"""CRC-32 of many byte ranges at once, by position tables.

Without its start value the checksum is linear over XOR: a byte contributes a
value that depends on the byte and on how many bytes follow it. A table holds
these contributions for every byte and distance from the end, so the checksum
of a range is the XOR of one table entry per byte (``bitwise_xor.reduceat`` over
all ranges together) and of a constant for its length, which carries the start
value and the final inversion.

Ranges longer than the table are cut into blocks from their end; the blocks'
values fold in pairs, each time shifting the earlier one over the bytes of the
later one by four lookups.
"""

from __future__ import annotations

import numpy as np

REACH = 64  # distances in the table; a power of two
WORK = 1 << 18  # bytes looked up at once
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)


def _position_table() -> np.ndarray:
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1)
    rows = [one]
    for _ in range(REACH - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ one[rows[-1] & np.uint32(255)])
    return np.concatenate(rows)


TABLE = _position_table()  # at distance * 256 + byte


def _moved(values: np.ndarray, move: np.ndarray) -> np.ndarray:
    result = move[0][values & np.uint32(255)]
    for k in (1, 2, 3):
        result ^= move[k][(values >> np.uint32(8 * k)) & np.uint32(255)]
    return result


def _moves(n: int) -> list[np.ndarray]:
    """For k < n: the lookups that carry a value over 2**k zero bytes."""
    by_byte = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    moves = [np.stack([(x >> np.uint32(8)) ^ TABLE[x & np.uint32(255)] for x in by_byte])]
    while len(moves) < n:
        moves.append(np.stack([_moved(row, moves[-1]) for row in moves[-1]]))
    return moves


MOVES = _moves(48)


def _constants(lengths: np.ndarray) -> np.ndarray:
    """Checksum of so many zero bytes."""
    value = np.full(len(lengths), ONES)
    for k in range(int(lengths.max()).bit_length() if len(lengths) else 0):
        odd = (lengths >> k) & 1 == 1
        value[odd] = _moved(value[odd], MOVES[k])
    return value ^ ONES


CONSTANTS = _constants(np.arange(REACH + 1))


def _raw(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions over each range of 1 to REACH bytes."""
    result = np.empty(len(starts), np.uint32)
    lengths = ends - starts
    total = np.cumsum(lengths)
    done = 0
    while done < len(starts):
        before = int(total[done - 1]) if done else 0
        stop = max(int(np.searchsorted(total, before + WORK, "right")), done + 1)
        n = lengths[done:stop]
        heads = total[done:stop] - n - before
        at = np.arange(int(total[stop - 1]) - before) + np.repeat(starts[done:stop] - heads, n)
        entry = np.repeat((ends[done:stop] - 1) << 8, n)
        entry -= at << 8
        entry |= data[at]
        result[done:stop] = np.bitwise_xor.reduceat(TABLE.take(entry), heads)
        done = stop
    return result


def _folded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for longer ranges, in blocks of REACH bytes counted from their ends."""
    n = -(-(ends - starts) // REACH)
    heads = np.cumsum(n) - n
    values = np.empty(int(n.sum()), np.uint32)  # of each range, the last block first
    for some in range(0, len(values), WORK):
        at = np.arange(some, min(some + WORK, len(values)))
        of = np.searchsorted(heads, at, "right") - 1
        stops = ends[of] - REACH * (at - heads[of])
        values[at] = _raw(data, np.maximum(stops - REACH, starts[of]), stops)
    power = REACH.bit_length() - 1
    while len(values) > len(n):
        place = np.arange(len(values)) - np.repeat(heads, n)
        odd = np.flatnonzero(place & 1)
        values[odd - 1] ^= _moved(values[odd], MOVES[power])
        values = values[place & 1 == 0]
        n = (n + 1) // 2
        heads = np.cumsum(n) - n
        power += 1
    return values


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of data[start:end] for each range; no bytes have 0."""
    lengths = ends - starts
    result = np.zeros(len(starts), np.uint32)
    short = (lengths > 0) & (lengths <= REACH)
    if short.all():
        return _raw(data, starts, ends) ^ CONSTANTS[lengths]
    result[short] = _raw(data, starts[short], ends[short]) ^ CONSTANTS[lengths[short]]
    long = lengths > REACH
    result[long] = _folded(data, starts[long], ends[long]) ^ _constants(lengths[long])
    return result
