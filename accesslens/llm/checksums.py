"""CRC-32C of many byte strings at once."""

from __future__ import annotations

import numpy as np

#: The reversed Castagnoli polynomial; the rotation and the constant by
#: which the record format masks a checksum.
POLYNOMIAL = 0x82F63B78
MASK_ROTATION = 15
MASK_DELTA = 0xA282EAD8

BLOCK = 256  # bytes whose checksums are found side by side


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Registers after four bytes of zeros: for the lower and the upper two bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = (byte >> 1) ^ np.where(byte & 1, POLYNOMIAL, 0).astype(np.uint32)
    values = np.arange(1 << 16, dtype=np.uint32)
    both = []
    for register in (values, values << np.uint32(16)):
        for _ in range(4):
            register = byte[register & 0xFF] ^ (register >> np.uint32(8))
        both.append(register)
    return both[0], both[1]


_LOW, _HIGH = _tables()


def _over(register: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.take(register & np.uint32(0xFFFF)) ^ high.take(register >> np.uint32(16))


def _block_tables() -> tuple[np.ndarray, np.ndarray]:
    """The same for a whole block of zeros."""
    values = np.arange(1 << 16, dtype=np.uint32)
    low, high = values, values << np.uint32(16)
    for _ in range(BLOCK // 4):
        low, high = _over(low, _LOW, _HIGH), _over(high, _LOW, _HIGH)
    return low, high


_BLOCK_LOW, _BLOCK_HIGH = _block_tables()


def crc32c(strings: list[bytes]) -> np.ndarray:
    """CRC-32C of each string of at least 4 bytes.

    A register of zeros ignores zeros in front, so strings are filled up in front to
    whole blocks; the usual start value is mixed into the first four bytes instead.
    Blocks are independent until their registers are chained.
    """
    if not strings:
        return np.zeros(0, np.uint32)
    lengths = np.array([len(s) for s in strings])
    if lengths.min() < 4:
        raise ValueError("strings of fewer than 4 bytes")
    blocks = -(-lengths // BLOCK)
    order = np.argsort(-blocks, kind="stable")
    ends = np.cumsum(blocks[order]) * BLOCK
    data = np.zeros(int(ends[-1]), np.uint8)
    for i, end in zip(order, ends, strict=True):
        start = end - lengths[i]
        data[start:end] = np.frombuffer(strings[i], np.uint8)
        data[start : start + 4] ^= 0xFF
    words = data.view("<u4").reshape(-1, BLOCK // 4).T.copy()
    register = np.zeros(words.shape[1], np.uint32)
    for word in words:
        register = _over(register ^ word, _LOW, _HIGH)
    # chain: strings with more blocks come first, so those with a j-th one are a prefix
    first = (ends - blocks[order] * BLOCK) // BLOCK
    chained = register[first]
    for j in range(1, int(blocks.max())):
        n = int(np.searchsorted(-blocks[order], -j, side="left"))
        after = _over(chained[:n], _BLOCK_LOW, _BLOCK_HIGH)
        chained[:n] = after ^ register[first[:n] + j]
    result = np.empty(len(strings), np.uint32)
    result[order] = ~chained
    return result


def masked(crc: np.ndarray) -> np.ndarray:
    rotated = (crc >> np.uint32(MASK_ROTATION)) | (crc << np.uint32(32 - MASK_ROTATION))
    return rotated + np.uint32(MASK_DELTA)
