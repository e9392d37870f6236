"""Arrays of numbers packed into bytes, for what tasks send to each other: sorted numbers as differences, leading zero bytes left out."""

from __future__ import annotations

import struct

import numpy as np


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as byte planes (without the leading planes that are zero), compressed."""
    import pyarrow as pa

    out = [struct.pack("<B", len(arrays))]
    for x in arrays:
        x = np.ascontiguousarray(x, dtype="<u8")
        k = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        body = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :k].T).tobytes()
        small = pa.compress(body, codec="zstd", asbytes=True) if len(body) > 64 else body
        out += [struct.pack("<IBI", len(x), k, len(small)), small]
    return b"".join(out)


def unpack(body: bytes) -> list[np.ndarray]:
    import pyarrow as pa

    out, at = [], 1
    for _ in range(body[0]):
        n, k, size = struct.unpack_from("<IBI", body, at)
        at += 9
        small = body[at : at + size]
        raw = pa.decompress(small, decompressed_size=n * k, codec="zstd", asbytes=True) if n * k > 64 else small
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :k] = np.frombuffer(raw, np.uint8).reshape(k, n).T
        out.append(planes.reshape(-1).view("<u8").astype(np.uint64, copy=False))
        at += size
    return out


def sort_pack(h: np.ndarray, *others: np.ndarray) -> bytes:
    """pack() of sorted hashes as differences, and of what belongs to them."""
    return pack(np.diff(h, prepend=np.uint64(0)), *others)


def sort_unpack(body: bytes) -> list[np.ndarray]:
    h, *others = unpack(body)
    return [np.cumsum(h, dtype=np.uint64), *others]
