import os

import numpy as np
import pytest

from marlstone.llm import media


@pytest.mark.parametrize("n", [64, 128, 64 * 6, 64 * 7, 64 * 37, 64 * 800])
def test_payload_round_trip(n):
    for payload in (os.urandom(n), bytes(n), b"\xff" * n):
        file = media.encode(payload)
        assert media.Decoder(file).payload() == payload
        assert media.encode(payload) == file


def test_numpy_paths_agree_with_symbol_paths(monkeypatch):
    """The same files, read with every shortcut disabled."""
    payload = os.urandom(64 * 20)
    fast = media.Decoder(media.encode(payload))

    class Slow(media.Decoder):
        def _ac_first(self, flat, block, codes, ss, se, al, part):
            return super()._ac_first(flat, block, codes | {(99, 0): 0}, ss, se, al, part)

    slow = Slow(media.encode(payload))
    assert all((a == b).all() for a, b in zip(fast.coefficients, slow.coefficients))


class Writer:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> k & 1 for k in range(n - 1, -1, -1)]

    def signed(self, v, size):
        self.put(v if v > 0 else v + (1 << size) - 1, size)


def test_general_scans_with_runs_and_refinement():
    """A grey file with zero runs, EOB runs, new coefficients in refinement, and every symbol at eight bits."""
    rng = np.random.default_rng(3)
    blocks = np.where(rng.random((6, 64)) < 0.15, rng.integers(-30, 31, (6, 64)), 0)
    blocks[2, 1:] = 0
    blocks[3, 1:] = 0
    blocks[4, 1:] = 0
    blocks[4, 40] = 1  # only the refinement scan shows it
    symbols = list(range(255))
    dht = lambda kind: media.segment(0xC4, bytes([kind, *[0] * 7, 255, *[0] * 8, *symbols]))
    shifted = lambda v: np.sign(v) * (np.abs(v) >> 1)
    out = [b"\xff\xd8", media.segment(0xDB, bytes([0]) + bytes([2] * 64)), dht(0x00), dht(0x10)]
    out.append(media.segment(0xC2, bytes([8, 0, 16, 0, 24, 1, 1, 0x11, 0])))
    dc, last = Writer(), 0
    for v in blocks[:, 0]:
        d = int(v >> 1) - last
        last += d
        size = abs(d).bit_length()
        dc.put(size, 8)
        if size:
            dc.signed(d, size)
    refine = Writer()
    for v in blocks[:, 0]:
        refine.put(int(v) & 1, 1)
    first, run = Writer(), 0

    def flush(w, run):
        if run:
            r = run.bit_length() - 1
            w.put(r << 4, 8)
            w.put(run - (1 << r), r)

    for b in shifted(blocks):
        zeros = 0
        places = np.flatnonzero(b[1:]) + 1
        if len(places):
            flush(first, run)
            run = 0
        for k in range(1, (places[-1] if len(places) else 0) + 1):
            if not b[k]:
                zeros += 1
                continue
            while zeros > 15:
                first.put(0xF0, 8)
                zeros -= 16
            size = int(abs(b[k])).bit_length()
            first.put(zeros << 4 | size, 8)
            first.signed(int(b[k]), size)
            zeros = 0
        if not len(places) or places[-1] < 63:
            run += 1
    flush(first, run)
    second, run, corrections = Writer(), 0, []

    def flush2(run):
        if run:
            flush(second, run)
            second.bits += corrections
            corrections.clear()

    for b in blocks:
        zeros, pending = 0, []
        fresh = [k for k in range(1, 64) if abs(b[k]) == 1]
        end = fresh[-1] if fresh else 0
        if fresh:
            flush2(run)
            run = 0
        for k in range(1, 64):
            v = int(b[k])
            if k > end:
                if abs(v) > 1:
                    pending.append(abs(v) & 1)
                continue
            if abs(v) > 1:
                pending.append(abs(v) & 1)
            elif v == 0:
                if zeros == 15:
                    second.put(0xF0, 8)
                    second.bits += pending
                    pending, zeros = [], 0
                else:
                    zeros += 1
            else:
                second.put(zeros << 4 | 1, 8)
                second.put(1 if v > 0 else 0, 1)
                second.bits += pending
                pending, zeros = [], 0
        if end < 63:
            run += 1
            corrections += pending
    flush2(run)
    scan = lambda ss, se, ah, al, w: media.scan_header([(1, 0)], ss, se, ah, al) + media.stuffed(np.array(w.bits, np.uint8))
    out += [scan(0, 0, 0, 1, dc), scan(1, 63, 0, 1, first), scan(0, 0, 1, 0, refine), scan(1, 63, 1, 0, second), b"\xff\xd9"]
    file = media.Decoder(b"".join(out))
    assert (file.coefficients[0].reshape(-1, 64) == blocks).all()
    assert file.rgb().shape == (16, 24, 3)


def test_flat_block_has_the_mean_of_its_dc():
    file = media.Decoder(media.encode(bytes(64)))
    file.coefficients = [np.zeros_like(c) for c in file.coefficients]
    file.coefficients[0][..., 0] = 8 * 20
    assert (file.rgb() == 148).all()


def test_rejects_other_files():
    with pytest.raises(ValueError):
        media.Decoder(b"GIF89a")
    with pytest.raises(ValueError):
        media.encode(b"x")


def test_query_columns(spark):
    rows = [(1, "héllo", "x"), (2, None, "x"), (3, "", "x"), (4, "a" * 64, "x"), (4, "a" * 64, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, feature string")
    got = {(r.doc_id, r.n_bytes, r.payload_bytes) for r in media.read_media(media.to_media(df), tensors=True).collect() if len(r.tensor.rgb) == r.tensor.height * r.tensor.width * 3}
    assert got == {(1, 6, 64), (2, 0, 64), (3, 0, 64), (4, 64, 64)}
    assert media.read_media(media.to_media(df.limit(0))).count() == 0
