"""Media columns: progressive JPEG, coefficients in and full-resolution RGB tensors out.

The coder stores a payload losslessly in the unit of the format, the quantised
coefficient: 64 bytes are the 64 zigzag coefficients of one 8 x 8 block, each
byte b as OFFSET + b.  Blocks fill the 4:2:0 MCUs of a YCbCr frame (4 Y, Cb, Cr
each) in order; a comment segment holds the payload's length.  The scans
are those of a usual progressive file: DC first and bit by bit, AC by spectral
bands (1-5, 6-63) at a point transform, then AC refinement bit by bit.

The reader is a decoder of progressive Huffman-coded JPEG: every scan adds its
bits to the coefficient arrays.  Two kinds of AC scan have no data-dependent
layout and are read by numpy at once: first passes whose table has a single
symbol (run 0, one size), and refinement passes over blocks without a zero
coefficient in the band, which are EOB runs of plain bits.  All others are read
symbol by symbol.  Blocks are then inverse-transformed by one matrix product,
chroma is upsampled, and the tensor is cropped to the frame.

Edge cases: null and empty text has a payload of 64 zero bytes; equal payloads
give equal files; repeated rows each keep their row; input columns named like
an output are replaced; an empty table gives no rows; a file that is not
progressive JPEG raises ValueError.  A text is coded and decoded in one task,
which takes about 40 bytes of memory for each of its bytes.

The query writes the files to a table of the shared folder, decodes them from
there and returns the tensors with the features.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, table
from .textvec import pieces

OFFSET = 256
AC_SHIFT, DC_SHIFT = 2, 8
BANDS = ((1, 5), (6, 63))
#: Horizontal and vertical sampling of Y, Cb and Cr.
SAMPLING = ((2, 2), (1, 1), (1, 1))


@functools.cache
def zigzag() -> np.ndarray:
    """natural[k]: the row-major place of the k-th coefficient."""
    cells = sorted(((i, j) for i in range(8) for j in range(8)), key=lambda c: (sum(c), c[0] if sum(c) % 2 else c[1]))
    return np.array([8 * i + j for i, j in cells])


@functools.cache
def inverse_transform() -> np.ndarray:
    """Row k: the 64 samples that the k-th coefficient in zigzag order adds."""
    u, x = np.arange(8)[:, None], np.arange(8)[None, :]
    c = np.where(u == 0, np.sqrt(0.125), 0.5) * np.cos((2 * x + 1) * u * np.pi / 16)
    full = np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)
    return full[zigzag()].astype(np.float32)


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def scan_header(components: list[tuple[int, int]], ss: int, se: int, ah: int, al: int) -> bytes:
    return segment(0xDA, bytes([len(components), *[b for c, t in components for b in (c, t)], ss, se, ah << 4 | al]))


def stuffed(bits: np.ndarray) -> bytes:
    """Entropy-coded bytes of a bit array: filled with ones, a zero after each 0xFF."""
    body = np.packbits(np.concatenate((bits, np.ones(-len(bits) % 8, np.uint8)))) if len(bits) % 8 else np.packbits(bits)
    return body.tobytes().replace(b"\xff", b"\xff\x00")


def refine_bits(bits: np.ndarray) -> bytes:
    """A refinement scan over blocks without zeros: runs of at most 2 ** 15 - 1 blocks, each EOB14 of all code and its plain bits."""
    out = []
    for at in range(0, len(bits), 32767):
        part = bits[at : at + 32767]
        size = len(part).bit_length() - 1
        # The code of EOBn is its n in four bits, in a table of the fifteen symbols EOB0 .. EOB14.
        head = [size >> k & 1 for k in (3, 2, 1, 0)] + [(len(part) - (1 << size)) >> k & 1 for k in range(size - 1, -1, -1)]
        out += [np.array(head, np.uint8), part.ravel()]
    return stuffed(np.concatenate(out))


@functools.cache
def tables() -> bytes:
    """DQT of ones, and Huffman tables: DC sizes 0 and 1; AC of size 7 only; EOB0 .. EOB14 at four bits each."""
    ones = segment(0xDB, bytes([0]) + bytes([1] * 64))
    dc = segment(0xC4, bytes([0x00, 1, 1, *[0] * 14, 0, 1]))
    first = segment(0xC4, bytes([0x10, 1, *[0] * 15, (OFFSET >> AC_SHIFT).bit_length()]))
    eob = segment(0xC4, bytes([0x11, 0, 0, 0, 15, *[0] * 12, *[n << 4 for n in range(15)]]))
    return ones + dc + first + eob


def encode(payload: bytes) -> bytes:
    """A progressive JPEG file whose coefficients hold the payload (a positive multiple of 64 bytes)."""
    if not payload or len(payload) % 64:
        raise ValueError("the payload must be a positive multiple of 64 bytes")
    n = len(payload) // 64
    mcus = -(-n // 6)
    wide = int(np.ceil(np.sqrt(mcus)))
    high = -(-mcus // wide)
    blocks = np.zeros((wide * high * 6, 64), np.uint8)
    blocks[:n] = np.frombuffer(payload, np.uint8).reshape(n, 64)
    grid = blocks.reshape(high, wide, 6, 64)
    planes = [grid[:, :, :4].reshape(high, wide, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64), grid[:, :, 4].reshape(-1, 64), grid[:, :, 5].reshape(-1, 64)]
    dc_bits = np.unpackbits(grid[..., 0].ravel()[:, None], axis=1)
    out = [b"\xff\xd8", segment(0xFE, b"payload %d" % len(payload)), tables()]
    out.append(segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + bytes(b for c, (h, v) in enumerate(SAMPLING) for b in (c + 1, h << 4 | v, 0))))
    # DC >> 8 is 1 in every block: a difference of 1 in each component's first block, then of 0.
    head = np.array([1, 0, 1, 0, 0, 0, 1, 0, 1, 1, 0, 1], np.uint8)
    out += [scan_header([(1, 0), (2, 0), (3, 0)], 0, 0, 0, DC_SHIFT), stuffed(np.concatenate((head, np.zeros(grid.shape[0] * grid.shape[1] * 6 - 6, np.uint8))))]
    for c, plane in enumerate(planes):
        for ss, se in BANDS:  # code 0, then seven bits of OFFSET + b >> 2
            out += [scan_header([(c + 1, 0)], ss, se, 0, AC_SHIFT), ((plane[:, ss : se + 1] >> AC_SHIFT) | (OFFSET >> AC_SHIFT)).tobytes()]
    for al in range(DC_SHIFT - 1, -1, -1):
        out += [scan_header([(1, 0), (2, 0), (3, 0)], 0, 0, al + 1, al), stuffed(dc_bits[:, 7 - al])]
    for al in range(AC_SHIFT - 1, -1, -1):
        for c, plane in enumerate(planes):
            out += [scan_header([(c + 1, 1)], 1, 63, al + 1, al), refine_bits(plane[:, 1:] >> al & 1)]
    return b"".join([*out, b"\xff\xd9"])


class Bits:
    """Reads entropy-coded bytes bit by bit; ones follow the end."""

    def __init__(self, body: bytes):
        self.bits, self.at = np.unpackbits(np.frombuffer(body, np.uint8)), 0

    def take(self, n: int) -> int:
        out = 0
        for b in self.bits[self.at : self.at + n].tolist():
            out = out << 1 | b
        short = max(0, self.at + n - len(self.bits))
        self.at += n
        return (out << short) | ((1 << short) - 1)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | (int(self.bits[self.at]) if self.at < len(self.bits) else 1)
            self.at += 1
            if (n, code) in codes:
                return codes[n, code]
        raise ValueError("no such Huffman code")

    def signed(self, size: int) -> int:
        v = self.take(size)
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def read_tables(body: bytes, into: dict) -> None:
    while body:
        counts, symbols = body[1:17], body[17 : 17 + sum(body[1:17])]
        codes, code, k = {}, 0, 0
        for n, many in enumerate(counts, 1):
            for _ in range(many):
                codes[n, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1
        into[body[0]] = codes
        body = body[17 + len(symbols) :]


class Decoder:
    """Coefficient arrays (block rows, block columns, 64 in zigzag order) of each component, after all scans."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        self.huffman: dict[int, dict] = {}
        self.quantisers: dict[int, np.ndarray] = {}
        self.comment, self.restart, self.coefficients = b"", 0, []
        self.layouts: dict[tuple[int, ...], tuple] = {}
        at = 2
        while at < len(data):
            marker = data[at + 1]
            if marker == 0xD9:
                break
            (size,) = struct.unpack(">H", data[at + 2 : at + 4])
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xC2:
                self._frame(body)
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("only progressive Huffman-coded frames are read")
            elif marker == 0xC4:
                read_tables(body, self.huffman)
            elif marker == 0xDB:
                while body:
                    wide = 1 + (body[0] >> 4)
                    self.quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.float32)
                    body = body[1 + 64 * wide :]
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xDD:
                (self.restart,) = struct.unpack(">H", body)
            elif marker == 0xDA:
                parts = []
                while True:  # to the next marker; restart markers part the scan
                    end = data.find(b"\xff", at)
                    begin = at
                    while end >= 0 and data[end + 1] == 0:
                        end = data.find(b"\xff", end + 2)
                    end = len(data) if end < 0 else end
                    parts.append(data[begin:end].replace(b"\xff\x00", b"\xff"))
                    at = end
                    if end < len(data) and 0xD0 <= data[end + 1] <= 0xD7:
                        at += 2
                        continue
                    break
                self._scan(body, parts)

    def _frame(self, body: bytes) -> None:
        _, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        self.components = [(body[6 + 3 * c], body[7 + 3 * c] >> 4, body[7 + 3 * c] & 15, body[8 + 3 * c]) for c in range(n)]
        self.h, self.v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        self.mcus = -(-self.height // (8 * self.v)), -(-self.width // (8 * self.h))
        self.coefficients = [np.zeros((self.mcus[0] * v, self.mcus[1] * h, 64), np.int32) for _, h, v, _ in self.components]

    def _scan(self, body: bytes, parts: list[bytes]) -> None:
        n = body[0]
        which = [(next(i for i, c in enumerate(self.components) if c[0] == body[1 + 2 * k]), body[2 + 2 * k]) for k in range(n)]
        ss, se, (ah, al) = body[1 + 2 * n], body[2 + 2 * n], divmod(body[3 + 2 * n], 16)
        owner, block, groups, each = self._layout(tuple(c for c, _ in which))
        step = self.restart * each if self.restart else len(block)
        flat = [a.reshape(-1, 64) for a in self.coefficients]
        for part, at in zip(parts, range(0, len(block), max(step, 1)), strict=False):
            own = slice(at, at + step)
            if ss == 0 and ah:
                bits = np.unpackbits(np.frombuffer(part, np.uint8), count=len(block[own])).astype(np.int32) << al
                for c, places in groups if not self.restart else [(c, np.flatnonzero(owner[own] == c)) for c, _ in groups]:
                    flat[c][block[own][places], 0] |= bits[places]
            elif ss == 0:
                self._dc_first(flat, owner[own], block[own], {c: self.huffman[t >> 4] for c, t in which}, al, part)
            else:
                codes = self.huffman[0x10 | which[0][1] & 15]
                (self._ac_refine if ah else self._ac_first)(flat[which[0][0]], block[own], codes, ss, se, al, part)

    def _layout(self, which: tuple[int, ...]) -> tuple:
        """The component and the block of each unit of a scan of these components, the places of each component, and the units of an MCU."""
        if which not in self.layouts:
            if len(which) > 1:
                owners, index = [], []
                for c in which:
                    _, h, v, _ = self.components[c]
                    own = np.arange(self.mcus[0] * v * self.mcus[1] * h).reshape(self.mcus[0], v, self.mcus[1], h).transpose(0, 2, 1, 3).reshape(-1, h * v)
                    owners += [c] * (h * v)
                    index.append(own)
                block, each = np.concatenate(index, axis=1).ravel(), len(owners)
                owner = np.tile(np.array(owners), len(block) // each)
            else:
                _, h, v, _ = self.components[which[0]]
                cols = self.coefficients[which[0]].shape[1]
                used = -(-(-(-self.height * v // self.v)) // 8), -(-(-(-self.width * h // self.h)) // 8)
                block = (np.arange(used[0])[:, None] * cols + np.arange(used[1])).ravel()
                owner, each = np.broadcast_to(np.int64(which[0]), len(block)), 1
            self.layouts[which] = owner, block, [(c, np.flatnonzero(owner == c)) for c in which], each
        return self.layouts[which]

    def _dc_first(self, flat, owner, block, codes, al, part) -> None:
        bits, last = Bits(part), {}
        ones = np.append(np.flatnonzero(bits.bits), len(bits.bits))
        zero_is_0 = all(c.get((1, 0)) == 0 for c in codes.values())
        for k in range(len(block)):
            if zero_is_0 and len(last) == len(codes) and ones[np.searchsorted(ones, bits.at)] - bits.at >= len(block) - k:
                for c, value in last.items():  # only differences of zero follow
                    flat[c][block[k:][owner[k:] == c], 0] = value << al
                return
            c = int(owner[k])
            last[c] = last.get(c, 0) + bits.signed(bits.symbol(codes[c]))
            flat[c][block[k], 0] = last[c] << al

    def _ac_first(self, flat, block, codes, ss, se, al, part) -> None:
        if len(codes) == 1:
            ((length, code), symbol), wide = next(iter(codes.items())), se - ss + 1
            if symbol >> 4 == 0 and symbol & 15:
                size, n = symbol & 15, len(block) * wide
                if length + size == 8:
                    value = np.frombuffer(part, np.uint8)[:n].astype(np.int32) & ((1 << size) - 1)
                else:
                    fields = np.unpackbits(np.frombuffer(part, np.uint8))[: n * (length + size)].reshape(n, length + size)[:, length:]
                    value = fields.astype(np.int32) @ (1 << np.arange(size - 1, -1, -1))
                value = np.where(value >> (size - 1), value, value - (1 << size) + 1) << al
                flat[block, ss : se + 1] = value.reshape(len(block), wide)
                return
        bits, run = Bits(part), 0
        for b in block.tolist():
            if run:
                run -= 1
                continue
            k = ss
            while k <= se:
                r, size = divmod(bits.symbol(codes), 16)
                if size:
                    k += r
                    flat[b, k] = bits.signed(size) * (1 << al)
                    k += 1
                elif r == 15:
                    k += 16
                else:
                    run = (1 << r) - 1 + (bits.take(r) if r else 0)
                    break

    def _ac_refine(self, flat, block, codes, ss, se, al, part) -> None:
        bits, run, bit, at = Bits(part), 0, 1 << al, 0
        while at < len(block):
            if not run:
                start = bits.at
                r, size = divmod(bits.symbol(codes), 16)
                if not size and r < 15:
                    run = (1 << r) + (bits.take(r) if r else 0)
                else:
                    bits.at = start
            if run:  # corrections only, for as many blocks
                b = block[at : at + run]
                band = flat[b, ss : se + 1]
                if band.all():
                    got = bits.bits[bits.at : bits.at + band.size].reshape(band.shape)
                    flat[b, ss : se + 1] = band + np.where(band > 0, got, -got.astype(np.int32)) * np.where(np.abs(band) & bit, 0, bit)
                    bits.at += band.size
                    at, run = at + len(b), 0
                    continue
                row, col = np.nonzero(band)
                got = bits.bits[bits.at : bits.at + len(row)].astype(np.int32)
                value = band[row, col]
                fresh = (np.abs(value) & bit) == 0
                band[row, col] = value + np.where(fresh, got * bit * np.sign(value), 0)
                flat[b, ss : se + 1] = band
                bits.at += len(row)
                at, run = at + len(b), 0
                continue
            b, k = int(block[at]), ss
            while k <= se:
                r, size = divmod(bits.symbol(codes), 16)
                if not size and r < 15:
                    run = (1 << r) + (bits.take(r) if r else 0)
                    break
                value = (bit if bits.take(1) else -bit) if size else 0
                while k <= se:
                    old = int(flat[b, k])
                    if old:
                        if bits.take(1) and not abs(old) & bit:
                            flat[b, k] += bit if old > 0 else -bit
                    elif r == 0:
                        break
                    else:
                        r -= 1
                    k += 1
                if value and k <= se:
                    flat[b, k] = value
                k += 1
            if run:  # this block's remaining coefficients belong to the run
                while k <= se:
                    old = int(flat[b, k])
                    if old and bits.take(1) and not abs(old) & bit:
                        flat[b, k] += bit if old > 0 else -bit
                    k += 1
                run -= 1
            at += 1

    def payload(self) -> bytes:
        """What encode() stored."""
        y, cb, cr = (a.astype(np.int64) - OFFSET for a in self.coefficients)
        high, wide = self.mcus
        grid = np.empty((high, wide, 6, 64), np.uint8)
        grid[:, :, :4] = y.reshape(high, 2, wide, 2, 64).transpose(0, 2, 1, 3, 4).reshape(high, wide, 4, 64)
        grid[:, :, 4], grid[:, :, 5] = cb, cr
        return grid.tobytes()[: int(self.comment.split()[1])]

    def rgb(self) -> np.ndarray:
        """The tensor (height, width, 3) of uint8."""
        planes = []
        for a, (_, h, v, q) in zip(self.coefficients, self.components, strict=True):
            rows, cols = a.shape[:2]
            samples = (a.reshape(-1, 64) * self.quantisers[q]) @ inverse_transform()
            plane = np.clip(samples.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8) + 128, 0, 255)
            plane = np.repeat(np.repeat(plane, self.v // v, axis=0), self.h // h, axis=1)
            planes.append(plane[: self.height, : self.width])
        if len(planes) == 1:
            planes = [planes[0], np.full_like(planes[0], 128), np.full_like(planes[0], 128)]
        y, cb, cr = planes
        cb, cr = cb - np.float32(128), cr - np.float32(128)
        out = np.empty((*y.shape, 3), np.uint8)
        for k, plane in enumerate((y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb)):
            out[..., k] = np.clip(plane + np.float32(0.5), 0, 255)
        return out


def _encode(batches):
    import pyarrow as pa

    for batch in pieces(batches, "_text"):
        files, sizes = [], []
        for raw in batch.column("_text").to_pylist():
            raw = raw or b""
            files.append(encode(raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)))
            sizes.append(len(raw))
        media = pa.array(files, pa.binary())
        yield pa.RecordBatch.from_arrays([*(c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "_text"), pa.array(sizes, pa.int64()), media], names=[*(n for n in batch.schema.names if n != "_text"), "n_bytes", "media"])


def _decode(tensors: bool):
    def run(batches):
        import pyarrow as pa

        for batch in pieces(batches, "media"):
            cols: list[list] = [[] for _ in range(6)]
            bodies = []
            for media in batch.column("media"):
                data = media.as_py()
                file = Decoder(data)
                payload, rgb = file.payload(), file.rgb()
                mean = rgb.reshape(-1, 3).mean(0, dtype=np.float64)
                feature = f"{rgb.shape[0]}x{rgb.shape[1]} r={mean[0]:.1f} g={mean[1]:.1f} b={mean[2]:.1f}"
                for c, v in zip(cols, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature), strict=True):
                    c.append(v)
                if tensors:
                    bodies.append({"height": rgb.shape[0], "width": rgb.shape[1], "rgb": rgb.tobytes()})
            new = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            if tensors:
                new.append(pa.array(bodies, pa.struct([("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary())])))
                names.append("tensor")
            keep = [i for i, n in enumerate(batch.schema.names) if n != "media"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new], names=[*(batch.schema.names[i] for i in keep), *names])

    return run


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _mapped(df: DataFrame, without: tuple[str, ...], payload: Column, name: str, run, made: str) -> DataFrame:
    """run on df's columns but `without`, which travel under names of their own, and payload as `name`; made: the fields it adds."""
    names = [c for c in df.columns if c not in without]
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], payload.alias(name))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != name)
    out = rows.mapInArrow(run, kept + made)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *out.columns[len(names) :])


def to_media(documents: DataFrame) -> DataFrame:
    """documents with n_bytes and media, the progressive JPEG file that holds the text, in place of text."""
    return _mapped(documents, ("text", "n_bytes", "media"), F.col("text").cast("binary"), "_text", _encode, "n_bytes long, media binary")


def read_media(media: DataFrame, tensors: bool = False) -> DataFrame:
    """media's rows with what is read back from their files: FEATURES, and the tensor struct<height, width, rgb> if asked for."""
    made = {f.split()[0] for f in FEATURES.split(", ")} | {"tensor"}
    return _mapped(media, (*made, "media"), F.col("media"), "media", _decode(tensors), FEATURES + ", tensor struct<height:int,width:int,rgb:binary>" * tensors)


def stored(documents: DataFrame) -> DataFrame:
    """documents' texts as media files in a table of the shared folder, and what is read back from the stored files, tensors included."""
    return read_media(materialise(to_media(documents), "media-files", compression="zstd"), tensors=True)


def query(spark, sf_dir: str) -> DataFrame:
    return stored(table(spark, sf_dir, "documents").select("doc_id", "text"))
