"""Matroska: EBML elements, clusters, lacing and cues to packet tables, and back.

``mux`` stores samples as one PCM track in laced SimpleBlocks, grouped in clusters, with cues.
``parse`` reads any Matroska bytes: variable-length ids and sizes, unknown sizes, SimpleBlocks and
BlockGroups, all four kinds of lacing, cues. A packet is a byte range of the stored file, with its
track and timestamp; the payload is read back by those ranges.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, rows_of

# Element ids of the Matroska specification.
EBML, SEGMENT, SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x114D9B74, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
DOC_TYPE, TIMESTAMP_SCALE, DURATION = 0x4282, 0x2AD7B1, 0x4489
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID, DEFAULT_DURATION = 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0x23E383
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE_BLOCK = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
TAGS, CHAPTERS, ATTACHMENTS = 0x1254C367, 0x1043A770, 0x1941A469
CONTENT_ENCODINGS = 0x6D80
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

FRAME, RATE, PER_BLOCK, PER_CLUSTER = 576, 8000, 8, 64


class Damaged(ValueError):
    """The bytes break the format; the message says where."""


# Writing


def vint(n: int, width: int = 0) -> bytes:
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return ((1 << 7 * width) | n).to_bytes(width, "big")


def element(key: int, body: bytes) -> bytes:
    return key.to_bytes((key.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(key: int, n: int) -> bytes:
    return element(key, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def block(track: int, relative: int, frames: list[bytes], lacing: int) -> bytes:
    """The body of a SimpleBlock. Fixed lacing needs frames of one size."""
    head = vint(track) + relative.to_bytes(2, "big", signed=True) + bytes([0x80 | lacing << 1])
    if lacing == NO_LACING:
        if len(frames) != 1:
            raise ValueError("a block without lacing holds one frame")
        return head + frames[0]
    sizes = [len(f) for f in frames]
    head += bytes([len(frames) - 1])
    if lacing == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == EBML_LACING and len(frames) > 1:
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            width = next(w for w in range(1, 9) if abs(b - a) < (1 << 7 * w - 1))
            head += vint(b - a + (1 << 7 * width - 1) - 1, width)
    elif lacing == FIXED and len(set(sizes)) > 1:
        raise ValueError("fixed lacing needs frames of one size")
    return head + b"".join(frames)


def mux(payload: bytes, lacing: int = FIXED) -> bytes:
    """``payload``, whose length is a positive multiple of FRAME, as 8-bit PCM samples in one track."""
    if not payload or len(payload) % FRAME:
        raise ValueError(f"a positive multiple of {FRAME} bytes is needed")
    n, per_block, ms = len(payload) // FRAME, PER_BLOCK if lacing else 1, FRAME * 1000 // RATE
    track = uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(FLAG_LACING, int(lacing > 0)) + element(CODEC_ID, b"A_PCM/INT/LIT") + uint(DEFAULT_DURATION, ms * 1_000_000)
    track += element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">f", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    body = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", n * ms))) + element(TRACKS, element(TRACK_ENTRY, track))
    cues = b""
    for c in range(0, n, PER_CLUSTER):
        blocks = [uint(TIMESTAMP, c * ms)]
        for f in range(c, min(n, c + PER_CLUSTER), per_block):
            frames = [payload[k * FRAME : (k + 1) * FRAME] for k in range(f, min(n, c + PER_CLUSTER, f + per_block))]
            blocks.append(element(SIMPLE_BLOCK, block(1, (f - c) * ms, frames, lacing)))
        cues += element(CUE_POINT, uint(CUE_TIME, c * ms) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, len(body))))
        body += element(CLUSTER, b"".join(blocks))
    return element(EBML, element(DOC_TYPE, b"matroska")) + element(SEGMENT, body + element(CUES, cues))


# Reading


@dataclass
class Media:
    """packets: (track, timestamp_ns, start, size, cluster, lacing, keyframe); cues: (track, timestamp_ns, cluster's start)."""

    scale: int = 1_000_000
    tracks: dict[int, dict] = field(default_factory=dict)
    clusters: list[int] = field(default_factory=list)
    packets: list[tuple] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    cues_true: bool = True


def read_vint(data: bytes, at: int, end: int, keep: bool = False) -> tuple[int, int, bool]:
    """Value, place behind it, whether all its bits are set (an unknown size). keep: with the length marker, as in ids."""
    if at >= end or not data[at]:
        raise Damaged(f"no variable-length number at {at}")
    width = 9 - data[at].bit_length()
    if at + width > end:
        raise Damaged(f"a number is cut off at {at}")
    n = int.from_bytes(data[at : at + width], "big")
    value = n ^ (1 << 7 * width)
    return n if keep else value, at + width, value == (1 << 7 * width) - 1


#: What a segment holds. A cluster of unknown size ends where one of these, or another segment, begins.
LEVEL_ONE = frozenset((SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, TAGS, CHAPTERS, ATTACHMENTS))


def head(data: bytes, at: int, end: int) -> tuple[int, int, int | None]:
    """(id, body, end) of the element at a place; the end is None if its size is unknown."""
    key, body, _ = read_vint(data, at, end, keep=True)
    n, body, unknown = read_vint(data, body, end)
    if unknown and key not in (SEGMENT, CLUSTER):
        raise Damaged(f"element {key:x} at {at} has no size")
    if not unknown and body + n > end:
        raise Damaged(f"element {key:x} at {at} runs over its parent's end")
    return key, body, None if unknown else body + n


def children(data: bytes, at: int, end: int):
    """(id, start, body, end) of each element in a range. One of unknown size goes to the range's end."""
    while at < end:
        key, body, stop = head(data, at, end)
        yield key, at, body, end if stop is None else stop
        at = end if stop is None else stop


def number(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def laced(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """(start, size) of each frame of a block's body behind its head."""
    if lacing == NO_LACING:
        return [(at, end - at)]
    if at >= end:
        raise Damaged(f"a lace is cut off at {at}")
    n, at, sizes = data[at] + 1, at + 1, []
    if lacing == FIXED:
        if (end - at) % n:
            raise Damaged(f"{end - at} bytes don't make {n} frames")
        sizes = [(end - at) // n] * (n - 1)
    elif lacing == XIPH:
        for _ in range(n - 1):
            size = 0
            while True:
                if at >= end:
                    raise Damaged(f"a lace is cut off at {at}")
                size += (b := data[at])
                at += 1
                if b < 255:
                    break
            sizes.append(size)
    else:
        for k in range(n - 1):
            begun = at
            value, at, _ = read_vint(data, at, end)
            sizes.append(value if not k else sizes[-1] + value - ((1 << 7 * (at - begun) - 1) - 1))
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise Damaged(f"the lace at {at} is longer than its block")
    out = []
    for size in [*sizes, last]:
        out.append((at, size))
        at += size
    return out


def parse(data: bytes) -> Media:
    """The packet table of Matroska bytes. Damaged where they break the format."""
    out, base, cue_points = Media(), None, []
    for key, _, at, end in children(data, 0, len(data)):
        if key != SEGMENT:
            continue
        base = at
        while at < end:
            start = at
            k, a, e = head(data, start, end)
            if k == CLUSTER:
                at = _cluster(data, start, a, end if e is None else e, e is None, out)
                continue
            if k in (EBML, SEGMENT):  # another file begins, behind a segment of unknown size
                break
            at = end if e is None else e
            if k == INFO:
                out.scale = next((number(data, x, y) for i, _, x, y in children(data, a, e) if i == TIMESTAMP_SCALE), out.scale)
            elif k == TRACKS:
                for i, _, x, y in children(data, a, e):
                    if i == TRACK_ENTRY:
                        t = {j: data[p:q] for j, _, p, q in children(data, x, y)}
                        out.tracks[int.from_bytes(t.get(TRACK_NUMBER, b""), "big")] = {"codec": t.get(CODEC_ID, b"").decode("ascii", "replace"), "type": int.from_bytes(t.get(TRACK_TYPE, b""), "big"), "frame_ns": int.from_bytes(t.get(DEFAULT_DURATION, b""), "big"), "encoded": CONTENT_ENCODINGS in t}
            elif k == CUES:
                for i, _, x, y in children(data, a, e):
                    if i == CUE_POINT:
                        point = [(j, p, q) for j, _, p, q in children(data, x, y)]
                        time = next((number(data, p, q) for j, p, q in point if j == CUE_TIME), 0)
                        for j, p, q in point:
                            if j == CUE_TRACK_POSITIONS:
                                v = {m: number(data, c, d) for m, _, c, d in children(data, p, q)}
                                cue_points.append((v.get(CUE_TRACK, 0), time, base + v.get(CUE_CLUSTER_POSITION, 0)))
    if base is None:
        raise Damaged("there is no segment")
    out.cues = [(t, time * out.scale, at) for t, time, at in cue_points]
    clusters = set(out.clusters)
    out.cues_true = all(at in clusters for _, _, at in out.cues)
    return out


def _cluster(data: bytes, start: int, at: int, end: int, unknown: bool, out: Media) -> int:
    """Reads a cluster, each element once, and returns the place behind it. Of unknown size, it ends before what can't be in it."""
    out.clusters.append(start)
    stamp, index = 0, len(out.clusters) - 1
    while at < end:
        key, a, e = head(data, at, end)
        if unknown and (key in LEVEL_ONE or key in (SEGMENT, EBML)):
            return at
        if e is None:
            raise Damaged(f"element {key:x} at {at} can't be in a cluster")
        at = e
        if key == TIMESTAMP:
            stamp = number(data, a, e)
        elif key == SIMPLE_BLOCK:
            _block(data, a, e, stamp, index, out, None, 0)
        elif key == BLOCK_GROUP:
            inner = [(k, x, y) for k, _, x, y in children(data, a, e)]
            duration = next((number(data, x, y) for k, x, y in inner if k == BLOCK_DURATION), 0)
            alone = all(k != REFERENCE_BLOCK for k, _, _ in inner)  # a block that refers to none is a keyframe
            for k, x, y in inner:
                if k == BLOCK:
                    _block(data, x, y, stamp, index, out, alone, duration)
    return end


def _block(data: bytes, at: int, end: int, stamp: int, index: int, out: Media, key: bool | None, duration: int = 0) -> None:
    """duration: of all the block's frames together, in the segment's ticks; 0 if not given."""
    track, at, _ = read_vint(data, at, end)
    if at + 3 > end:
        raise Damaged(f"a block is cut off at {at}")
    relative, flags = int.from_bytes(data[at : at + 2], "big", signed=True), data[at + 2]
    lacing, time = flags >> 1 & 3, (stamp + relative) * out.scale
    if out.tracks.get(track, {}).get("encoded"):
        raise Damaged(f"the frames of track {track} at {at} are encoded, which isn't undone")
    frames = laced(data, at + 3, end, lacing)
    step = out.tracks.get(track, {}).get("frame_ns", 0) or duration * out.scale // len(frames)
    if max(track, abs(time), abs(time + step * len(frames))) >= 1 << 63:
        raise Damaged(f"a track's number or a time at {at} is beyond 64 bits")
    for k, (p, n) in enumerate(frames):
        out.packets.append((track, time + k * step, p, n, index, lacing, bool(flags & 0x80) if key is None else key))


def read_back(data: bytes, media: Media, track: int = 1) -> bytes:
    return b"".join(data[p : p + n] for t, _, p, n, *_ in media.packets if t == track)


# Tables

PACKET = "track long, timestamp_ns long, start long, size long, cluster int, lacing int, keyframe boolean"


def packet_table(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """One row per packet of each row's Matroska bytes: the id, PACKET's columns, error.

    Null or empty bytes give no row. Bytes that break the format, have numbers beyond 64 bits or packets of a track whose content is encoded give one row with null packet
    columns and the reason in ``error``; a row's packets before the break aren't returned. Repeated
    rows give their packets each. Narrow: memory is one batch of media.
    """
    names = ["track", "timestamp_ns", "start", "size", "cluster", "lacing", "keyframe"]

    def run(batches):
        for b in batches:
            out = []
            for i, data in rows_of(b, "id", "media"):
                if not data:
                    continue
                try:
                    out += [(i, *p, None) for p in parse(data).packets]
                except Damaged as e:
                    out.append((i, *[None] * len(names), str(e)))
            cols = list(zip(*out)) if out else [()] * (len(names) + 2)
            types = [b.schema.field("id").type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["id", *names, "error"])

    kind = media.schema[id_col].dataType.simpleString()
    return mapped(media.select(media[id_col].alias("id"), media[media_col].alias("media")), run, f"id {kind}, {PACKET}, error string").withColumnRenamed("id", id_col)


def padded(raw: bytes) -> bytes:
    return raw + b"\xff" * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))


def features(media: Media, payload: bytes) -> str:
    """What the packet table and the samples show, as one string."""
    import numpy as np

    x = np.frombuffer(payload, np.uint8)
    last = media.packets[-1]
    return (
        f"tracks={len(media.tracks)};clusters={len(media.clusters)};packets={len(media.packets)};cues={len(media.cues)};cues_true={int(media.cues_true)};"
        f"last_ns={last[1]};last_start={last[2]};mean={x.mean():.4f};std={x.std():.4f};turns={int((x[1:] != x[:-1]).sum())};peak={int(x.max())};full={int((x == 255).sum())}"
    )


def media_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lacing: int = FIXED, with_media: bool = False) -> DataFrame:
    """Store each text as a Matroska file, read it back by its packet table, and describe it.

    The payload is the UTF-8 text, filled with bytes 255 to a positive multiple of FRAME. One row per row of
    ``docs``: the id, n_bytes (text), payload_bytes, payload_sha256 and tail_crc32 (last 32 bytes) of the payload
    as read back, media_bytes, media_sha256, feature (and media if ``with_media``). Null text: empty; a null id
    stays; equal texts give equal values; other columns aren't read. Narrow: one text in memory at a time besides
    the batch.
    """

    def run(batches):
        for b in batches:
            out = []
            for i, text in rows_of(b, "id", "text"):
                raw = (text or "").encode("utf-8", "surrogatepass")
                data = mux(padded(raw), lacing)
                table = parse(data)
                got = read_back(data, table)
                out.append((i, len(raw), len(got), hashlib.sha256(got).hexdigest(), zlib.crc32(got[-32:]), len(data), hashlib.sha256(data).hexdigest(), features(table, got), data))
            cols = list(zip(*out)) if out else [()] * 9
            types = [b.schema.field("id").type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            n = 8 + with_media
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types)], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media"][:n])

    kind = docs.schema[id_col].dataType.simpleString()
    made = mapped(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", media binary" * with_media)
    return made.withColumnRenamed("id", id_col)
