"""Baseline JPEG media columns: markers, Huffman-coded scans, DC-only luminance thumbnails, dimensions and hashes.

Reading is general: any baseline (SOF0/SOF1, 8-bit, Huffman) image, grey or colour with sampling factors, with or without
restart intervals. The scan's segments between restart markers don't depend on each other, so numpy decodes one
symbol of all segments of a batch at a time. The luminance thumbnail takes one pixel a block, from its DC alone.

Storing is lossless in the format's own unit, the quantised coefficient: byte b of the payload is coefficient b + 1 at
its place in zigzag order, 64 bytes a block, under a quantisation table of ones. No coefficient is zero, so every symbol
has run 0, and the Huffman tables are chosen so that common bytes take 8 bits. A comment segment holds the payload's
lengths. Restart intervals of INTERVAL blocks keep segments short.

Defined results: a null payload counts as empty; an empty payload is one block of zero bytes; equal payloads give equal
media; a byte string that is no baseline JPEG gives nulls and the reason in `error`.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import slices, utf8

INTERVAL = 8
#: Bytes decoded side by side.
BATCH = 1 << 20
#: Bits of amplitude -> length of its code, for coefficients 1 to 256; AC_END ends a block.
AC_LENGTHS = {7: 1, 6: 2, 5: 3, 4: 4, 3: 5, 2: 6, 1: 7, 8: 8, 9: 15}
AC_END, AC_END_LENGTH = 0x00, 16
DC_LENGTHS = {7: 1, 6: 2, 5: 3, 4: 4, 3: 5, 2: 6, 1: 7, 0: 8, 9: 15, 8: 16}
NOTE = b"quire payload "


def canonical(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Symbol -> (code, length), assigned as the format's BITS and HUFFVAL lists imply."""
    out, code, last = {}, 0, 0
    for symbol, n in sorted(lengths.items(), key=lambda x: x[1]):
        code <<= n - last
        out[symbol] = (code, n)
        code, last = code + 1, n
    return out


def huffman_segment(kind: int, lengths: dict[int, int]) -> bytes:
    order = sorted(lengths.items(), key=lambda x: x[1])
    bits = [sum(n == i for _, n in order) for i in range(1, 17)]
    return bytes([kind, *bits, *(s for s, _ in order)])


AC_TABLE = AC_LENGTHS | {AC_END: AC_END_LENGTH}


def _emitted(lengths: dict[int, int], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """For values low..high: code and amplitude as one number, and its length in whole bytes."""
    codes = canonical(lengths)
    value, size = np.zeros(high - low + 1, np.uint32), np.zeros(high - low + 1, np.int64)
    for v in range(low, high + 1):
        n = abs(v).bit_length()
        if n not in codes or (low > 0 and n == 0):
            continue
        code, length = codes[n]
        amplitude = v if v >= 0 else v + (1 << n) - 1
        assert (length + n) % 8 == 0
        value[v - low], size[v - low] = code << n | amplitude, (length + n) // 8
    return value, size


AC_VALUE, AC_SIZE = _emitted(AC_LENGTHS, 1, 256)
DC_VALUE, DC_SIZE = _emitted(DC_LENGTHS, -256, 256)
END_VALUE = canonical(AC_TABLE)[AC_END][0]


def segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


TABLES = segment(0xDB, bytes([0, *[1] * 64])) + segment(0xC4, huffman_segment(0x00, DC_LENGTHS)) + segment(0xC4, huffman_segment(0x10, AC_TABLE)) + segment(0xDD, INTERVAL.to_bytes(2, "big"))


def layout(blocks: int) -> tuple[int, int]:
    """Blocks across and down; the format holds 8191 either way."""
    across = max(math.isqrt(blocks - 1) + 1, -(-blocks // 8191))
    if across > 8191:
        raise ValueError("the payload is larger than one image holds")
    return across, -(-blocks // across)


def encode_payloads(data: np.ndarray, off: np.ndarray) -> list[bytes]:
    """One JPEG for each row's bytes."""
    size = np.diff(off)
    real = np.maximum(1, -(-size // 64))
    shape = [layout(int(n)) for n in real]
    blocks = np.array([a * b for a, b in shape], np.int64)
    first = np.concatenate([[0], np.cumsum(blocks)])
    total = int(first[-1])
    at = np.arange(total) - np.repeat(first[:-1], blocks)  # a block's place in its image
    fill = at >= np.repeat(real, blocks)
    padded = np.zeros(total * 64, np.uint8)
    padded[np.arange(len(data)) + np.repeat(first[:-1] * 64 - off[:-1], size)] = data
    padded = padded.reshape(total, 64)
    dc = padded[:, 0].astype(np.int64) + 1
    last = np.repeat(first[:-1] + real - 1, blocks)
    dc = np.where(fill, dc[last], dc)  # a filling block repeats the last one's mean and has no more
    before = np.concatenate([[0], dc[:-1]]) * (at % INTERVAL != 0)
    value, length = np.zeros((total, 64), np.uint32), np.zeros((total, 64), np.int64)
    value[:, 0], length[:, 0] = DC_VALUE[dc - before + 256], DC_SIZE[dc - before + 256]
    value[:, 1:], length[:, 1:] = AC_VALUE[padded[:, 1:]], AC_SIZE[padded[:, 1:]]
    length[fill, 1:] = 0
    value[fill, 1], length[fill, 1] = END_VALUE, 2
    value, length = value.ravel(), length.ravel()
    start = np.concatenate([[0], np.cumsum(length)])
    raw = np.zeros(int(start[-1]), np.uint8)
    for i in range(3):
        own = np.flatnonzero(length > i)
        raw[start[own] + i] = (value[own] >> (8 * (length[own] - 1 - i)).astype(np.uint32)) & 255
    # a zero byte after each 0xFF, and a restart marker after each interval but an image's last
    ends = start[64::64][((at + 1) % INTERVAL == 0) & (at + 1 < np.repeat(blocks, blocks))]
    extra = np.zeros(len(raw) + 1, np.int64)
    extra[1:] += raw == 0xFF
    np.add.at(extra, ends, 2)
    shift = np.cumsum(extra)
    out = np.zeros(len(raw) + int(shift[-1]), np.uint8)
    out[np.arange(len(raw)) + shift[:-1]] = raw
    number = (at[((at + 1) % INTERVAL == 0) & (at + 1 < np.repeat(blocks, blocks))] // INTERVAL) % 8
    place = ends + shift[ends] - 2
    out[place], out[place + 1] = 0xFF, 0xD0 + number
    edge = start[first * 64]
    edge = edge + shift[edge]
    scan, made = out.tobytes(), []
    for i, (across, down) in enumerate(shape):
        frame = bytes([8]) + (down * 8).to_bytes(2, "big") + (across * 8).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])
        note = segment(0xFE, NOTE + b"%d %d" % (size[i], real[i] * 64))
        made.append(b"\xff\xd8" + note + TABLES + segment(0xC0, frame) + segment(0xDA, bytes([1, 1, 0, 0, 63, 0])) + scan[edge[i] : edge[i + 1]] + b"\xff\xd9")
    return made


class Image:
    """What the markers of one image say. scan: the coded bytes, and where its segments begin and end."""

    def __init__(self, raw: bytes):
        if raw[:2] != b"\xff\xd8":
            raise ValueError("no start of image")
        self.quant, self.huff, self.interval, self.note, at = {}, {}, 0, b"", 2
        self.parts = None
        while True:
            while at < len(raw) and raw[at] == 0xFF and raw[at + 1 : at + 2] == b"\xff":
                at += 1
            if at + 4 > len(raw) or raw[at] != 0xFF:
                raise ValueError("a marker is missing")
            kind, n = raw[at + 1], int.from_bytes(raw[at + 2 : at + 4], "big")
            body, at = raw[at + 4 : at + 2 + n], at + 2 + n
            if n < 2 or len(body) != n - 2:
                raise ValueError("a segment is cut short")
            if kind == 0xDB:
                while body:
                    wide = body[0] >> 4
                    m = 64 * (1 + bool(wide))
                    self.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + m], ">u2" if wide else np.uint8).astype(np.int64)
                    body = body[1 + m :]
            elif kind == 0xC4:
                while body:
                    m = sum(body[1:17])
                    self.huff[body[0]] = (bytes(body[1:17]), bytes(body[17 : 17 + m]))
                    body = body[17 + m :]
            elif kind in (0xC0, 0xC1):
                if body[0] != 8:
                    raise ValueError("samples aren't of 8 bits")
                self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
                self.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
            elif kind in (0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                raise ValueError("not a baseline image")
            elif kind == 0xDD:
                self.interval = int.from_bytes(body, "big")
            elif kind == 0xFE and body.startswith(NOTE):
                self.note = body[len(NOTE) :]
            elif kind == 0xDA:
                break
        if not self.parts or not self.width or not self.height:
            raise ValueError("no frame before the scan")
        if body[0] != len(self.parts):
            raise ValueError("components in scans of their own")
        use = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
        if len(self.parts) == 1:
            self.parts = [(self.parts[0][0], 1, 1, self.parts[0][3])]
        self.h, self.v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        self.across, self.down = -(-self.width // (8 * self.h)), -(-self.height // (8 * self.v))
        #: For each block of an MCU: the component, its DC and AC table.
        self.plan = [(i, self.huff[use[p[0]][0]], self.huff[16 + use[p[0]][1]]) for i, p in enumerate(self.parts) for _ in range(p[1] * p[2])]
        scan = np.frombuffer(raw, np.uint8)[at:]
        mark = np.flatnonzero((scan[:-1] == 0xFF) & (scan[1:] != 0))
        mark = mark[scan[mark + 1] != 0xFF]
        stop = mark[(scan[mark + 1] & 0xF8) != 0xD0]
        end = int(stop[0]) if len(stop) else len(scan)
        restarts = mark[mark < end]
        self.bounds = np.concatenate([[0], restarts + 2]), np.concatenate([restarts, [end]])
        self.scan = scan[:end]
        self.mcus = self.across * self.down
        step = self.interval or self.mcus
        if len(restarts) + 1 < -(-self.mcus // step):
            raise ValueError("restart intervals are missing")
        self.counts = [min(step, self.mcus - i) for i in range(0, self.mcus, step)]

    def luminance(self, coefficients: np.ndarray) -> np.ndarray:
        """One 8-bit pixel a luminance block, from DC terms alone; coefficients: blocks in coded order."""
        n, h, v = len(self.plan), self.parts[0][1], self.parts[0][2]
        dc = coefficients.reshape(self.down, self.across, n, 64)[:, :, : h * v, 0].reshape(self.down, self.across, v, h)
        dc = dc.transpose(0, 2, 1, 3).reshape(self.down * v, self.across * h) * int(self.quant[self.parts[0][3]][0])
        grey = np.clip(np.rint(dc / 8 + 128), 0, 255).astype(np.uint8)
        return grey[: -(-self.height * v // (8 * self.v)), : -(-self.width * h // (8 * self.h))]


def lookup(table: tuple[bytes, bytes]) -> np.ndarray:
    """For each 16 bits ahead: the code's length times 256 plus its symbol; 0 where no code begins so."""
    out, code, k = np.zeros(1 << 16, np.int32), 0, 0
    for n in range(1, 17):
        for _ in range(table[0][n - 1]):
            out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | table[1][k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


_lookups: dict[tuple, np.ndarray] = {}


def decode_scans(images: list[Image]) -> list[np.ndarray]:
    """Coefficients (blocks in coded order, 64 in zigzag order) of images with the same plan, one symbol of all segments at a time."""
    plan = tuple(images[0].plan)
    if plan not in _lookups:
        _lookups.clear() if len(_lookups) > 8 else None
        _lookups[plan] = np.concatenate([lookup(t) for _, dc, ac in plan for t in (dc, ac)])
    table, part = _lookups[plan], np.array([p[0] for p in plan])
    starts, stops, counts, base = [], [], [], 0
    for im in images:
        m = len(im.counts)
        starts.append(im.bounds[0][:m] + base)
        stops.append(im.bounds[1][:m] + base)
        counts += im.counts
        base += len(im.scan)
    scan = np.concatenate([im.scan for im in images] + [np.zeros(16, np.uint8)])
    start = np.concatenate(starts)
    keep = np.ones(len(scan), bool)
    keep[1:][(scan[:-1] == 0xFF) & (scan[1:] == 0)] = False  # stuffed zeros
    moved = np.cumsum(keep) - keep
    scan, start = scan[keep], moved[start]
    wide = np.zeros(len(scan), np.uint64)
    tail = np.concatenate([scan, np.zeros(8, np.uint8)]).astype(np.uint64)
    for i in range(6):
        wide |= tail[i : i + len(scan)] << np.uint64(56 - 8 * i)
    limit = np.int64(8 * (len(scan) - 1))
    blocks = np.array(counts, np.int64) * len(plan)
    first = np.concatenate([[0], np.cumsum(blocks)])
    out = np.zeros(int(first[-1]) * 64, np.int16)
    pos, block, k = start.astype(np.int64) * 8, np.zeros(len(blocks), np.int64), np.zeros(len(blocks), np.int64)
    mean = np.zeros((len(blocks), len({p[0] for p in plan})), np.int64)
    who, left, home = np.arange(len(blocks)), blocks.copy(), first[:-1].copy()
    one, many = np.uint64(1), len(plan) > 1
    while len(who):
        ahead = wide[pos >> 3] << (pos & 7).astype(np.uint64)
        fresh = k == 0
        kind = ~fresh * 65536
        if many:
            kind = kind + (block % len(plan)) * 131072
        entry = table[kind + (ahead >> np.uint64(48)).astype(np.int64)]
        n, symbol = entry >> 8, entry & 255
        bits = symbol & 15
        amplitude = ((ahead << n.astype(np.uint64)) >> one >> (63 - bits).astype(np.uint64)).astype(np.int64)
        value = amplitude - np.where((amplitude << 1) >> bits, 0, (1 << bits) - 1)
        pos += n + bits
        run = symbol >> 4
        if fresh.any():
            own = part[block[fresh] % len(plan)] if many else 0
            mean[who[fresh], own] += value[fresh]
            value[fresh] = mean[who[fresh], own]
            run = np.where(fresh, 0, run)
        k += run
        stop = (bits == 0) & ~fresh
        put = ~stop & (k < 64)
        if put.all():
            out[(home + block) * 64 + k] = value
        else:
            out[((home + block) * 64 + k)[put]] = value[put]
        k += 1
        k[stop & (run < 15)] = 64
        over = k >= 64
        if over.any():
            block += over
            k[over] = 0
        gone = (block >= left) | (n == 0) | (pos > limit)
        if gone.any():
            stay = ~gone
            who, left, home, pos, block, k = who[stay], left[stay], home[stay], pos[stay], block[stay], k[stay]
    out = out.reshape(-1, 64)
    sizes = np.cumsum([0, *[im.mcus * len(plan) for im in images]])
    return [out[a:b] for a, b in zip(sizes[:-1], sizes[1:], strict=True)]


def average_hash(grey: np.ndarray) -> str:
    """64 bits: which of 8 x 8 cells of the thumbnail are at least as light as their mean."""
    rows, cols = np.linspace(0, grey.shape[0], 9).astype(int), np.linspace(0, grey.shape[1], 9).astype(int)
    sums = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1), np.int64)
    sums[1:, 1:] = grey.astype(np.int64).cumsum(0).cumsum(1)
    lo_r, hi_r = rows[:-1], np.maximum(rows[1:], rows[:-1] + 1)
    lo_c, hi_c = cols[:-1], np.maximum(cols[1:], cols[:-1] + 1)
    area = (hi_r - lo_r)[:, None] * (hi_c - lo_c)[None, :]
    cell = (sums[np.ix_(hi_r, hi_c)] - sums[np.ix_(lo_r, hi_c)] - sums[np.ix_(hi_r, lo_c)] + sums[np.ix_(lo_r, lo_c)]) / area
    return np.packbits(cell >= cell.mean()).tobytes().hex()


def read_images(raws: list[bytes]) -> list[dict | str]:
    """Of each: width, height, thumbnail, hashes, and the payload that its comment tells of; or why it can't be read."""
    out: list = [None] * len(raws)
    groups: dict[tuple, list[tuple[int, Image]]] = {}
    for i, raw in enumerate(raws):
        try:
            im = Image(raw)
            groups.setdefault(tuple(im.plan), []).append((i, im))
        except (ValueError, IndexError, KeyError) as e:
            out[i] = str(e) or type(e).__name__
    for own in groups.values():
        for (i, im), coefficients in zip(own, decode_scans([im for _, im in own]), strict=True):
            grey = im.luminance(coefficients)
            got = {"width": im.width, "height": im.height, "thumbnail": grey, "feature": f"{im.width}x{im.height}:{average_hash(grey)}:{hashlib.sha256(grey.tobytes()).hexdigest()[:16]}", "payload": None, "n_bytes": None}
            if im.note:
                n, padded = map(int, im.note.split())
                got |= {"n_bytes": n, "payload": (coefficients[: padded // 64] - 1).astype(np.uint8).tobytes()}
            out[i] = got
    return out


def write_media(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Columns key and media (binary): each row's payload (text or bytes; null: empty) as a baseline JPEG."""
    def run(batches):
        for batch in batches:
            data, off = utf8(batch, 1)
            for a, b in slices(off, BATCH):
                made = encode_payloads(data[off[a] : off[b]], off[a : b + 1] - off[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(made, pa.binary())], [key, "media"])

    return df.select(df[key].alias(key), df[payload].alias("__payload")).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, media binary")


READ = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int, error string"


def read_media(df: DataFrame, key: str, media: str = "media") -> DataFrame:
    """Key, then what the stored bytes say: dimensions, thumbnail hashes, and digests of the payload, if one was stored."""
    def run(batches):
        for batch in batches:
            off = utf8(batch, 1)[1]
            for a, b in slices(off, BATCH):
                raws = [x or b"" for x in batch.column(1).slice(a, b - a).to_pylist()]
                rows = []
                for raw, got in zip(raws, read_images(raws), strict=True):
                    row = dict.fromkeys(x.split()[0] for x in READ.split(", ")) | {"media_bytes": len(raw), "media_sha256": hashlib.sha256(raw).hexdigest()}
                    if isinstance(got, str):
                        row["error"] = got
                    else:
                        row |= {k: got[k] for k in ("n_bytes", "feature", "width", "height")}
                        if (p := got["payload"]) is not None:
                            row |= {"payload_bytes": len(p), "payload_sha256": hashlib.sha256(p).hexdigest(), "tail_crc32": zlib.crc32(p[-64:])}
                    rows.append(row)
                made = pa.RecordBatch.from_pylist(rows, pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[t]) for n, t in (x.split() for x in READ.split(", "))]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *made.columns], [key, *made.schema.names])

    return df.select(df[key].alias(key), F.col(media).alias("__media")).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, {READ}")
