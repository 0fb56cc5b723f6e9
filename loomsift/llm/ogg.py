"""Ogg media columns: write 8-bit samples into multiplexed logical streams, verify and read them back.

Layout of what is written, one container for each payload: two logical streams (serials from the
payload's CRC), each begun by an ``OggPCM`` style header packet and a comment packet that says which
stream of how many it is; data packets of ``PACKET`` samples, the last one shorter, go to the streams
by turns. Pages hold several packets, and packets go on over pages. A page's granule position is the
number of samples of its logical stream up to the end of the last packet that ends on it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.llm.common import frugal, portions, positional, table

#: Samples a second of the stored form.
RATE = 8000
#: Samples in a data packet.
PACKET = 4096
#: Payloads are padded to a positive multiple of so many bytes.
BLOCK = 64
#: Logical streams that the packets are dealt to.
STREAMS = 2
#: Lacing values of a page (of up to 255).
SEGMENTS = 40
#: Bytes of payloads that are written together, about; a longer text is a batch of its own, in memory with its container.
AT_ONCE = 4 << 20
NO_GRANULE = -1
# Fixed values of the container format (RFC 3533).
CAPTURE, CONTINUED, FIRST, LAST, LACE, MAX_SEGMENTS = b"OggS", 1, 2, 4, 255, 255
HEAD = struct.Struct("<4sBBqIIIB")
PCM_MAGIC, COMMENT_MAGIC = b"PCM     ", b"PCMcomm "
PCM_HEAD = struct.Struct(">8sHHIIBBHI")
PCM_U8 = 1

_REVERSE = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


class OggError(ValueError):
    """The bytes are not a whole, undamaged Ogg stream."""


def page_crc(page: bytes) -> int:
    """The container's CRC (polynomial 04C11DB7, not reflected, no inversion) of a page whose CRC field is zero.

    The reflected CRC of bit-reversed bytes is the bit-reversed plain CRC, which lets zlib do the work.
    """
    x = zlib.crc32(page.translate(_REVERSE), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "big").translate(_REVERSE), "little")


def lacing(length: int) -> bytes:
    """The lacing values of a packet: full segments and one shorter one, which may be empty."""
    full, rest = divmod(length, LACE)
    return b"\xff" * full + bytes((rest,))


class StreamWriter:
    """Pages of one logical stream."""

    def __init__(self, serial: int):
        self.serial, self.sequence = serial, 0

    def page(self, flags: int, granule: int, laces: bytes, body: bytes) -> bytes:
        head = HEAD.pack(CAPTURE, 0, flags, granule, self.serial, self.sequence, 0, len(laces)) + laces
        self.sequence += 1
        crc = page_crc(head + body)
        return head[:22] + crc.to_bytes(4, "little") + head[26:] + body

    def packets(self, packets: list[bytes], ends: list[int], segments: int = SEGMENTS, first: bool = False, last: bool = False) -> list[bytes]:
        """The pages of packets that begin a page and end one, with each packet's end in samples; without packets, one empty page."""
        laces, body, out, at = b"".join(lacing(len(p)) for p in packets), b"".join(packets), [], 0
        stops, stop = {}, 0  # the lacing value after each packet's last one
        for p, end in zip(packets, ends, strict=True):
            stop += len(p) // LACE + 1
            stops[stop] = end
        for i in range(0, max(len(laces), 1), segments):
            part = laces[i : i + segments]
            size = sum(part)
            ended = max((j for j in range(i + 1, i + len(part) + 1) if j in stops), default=None)
            flags = (CONTINUED if i and i not in stops else 0) | (FIRST if first and not i else 0) | (LAST if last and i + segments >= len(laces) else 0)
            out.append(self.page(flags, 0 if not laces else NO_GRANULE if ended is None else stops[ended], part, body[at : at + size]))
            at += size
        return out


def encode(payload: bytes, rate: int = RATE, packet: int = PACKET, streams: int = STREAMS, segments: int = SEGMENTS) -> bytes:
    """The payload as unsigned 8-bit samples in one physical stream of several logical ones."""
    base = zlib.crc32(payload)
    writers = [StreamWriter((base + k) & 0xFFFFFFFF) for k in range(streams)]
    out: list[bytes] = []
    for w in writers:
        out += w.packets([PCM_HEAD.pack(PCM_MAGIC, 0, 0, PCM_U8, rate, 8, 1, packet, 1)], [0], first=True)
    for k, w in enumerate(writers):
        out += w.packets([COMMENT_MAGIC + b"STREAM=%d/%d" % (k, streams)], [0])
    data: list[list[bytes]] = []
    for k, w in enumerate(writers):
        mine = [payload[at : at + packet] for at in range(k * packet, len(payload), streams * packet)]
        ends = np.cumsum([len(p) for p in mine]).tolist()
        data.append(w.packets(mine, ends, segments, last=True))
    for i in range(max(map(len, data))):  # pages of the streams by turns
        out += [pages_[i] for pages_ in data if i < len(pages_)]
    return b"".join(out)


def pages(media: bytes) -> Iterator[tuple[int, int, int, int, bytes, int]]:
    """flags, granule, serial, sequence, lacing values and body offset of each page; raises on damage."""
    at, end = 0, len(media)
    while at < end:
        if at + HEAD.size > end:
            raise OggError(f"a page header is cut off at byte {at}")
        mark, version, flags, granule, serial, sequence, crc, n = HEAD.unpack_from(media, at)
        if mark != CAPTURE or version:
            raise OggError(f"no page begins at byte {at}")
        body = at + HEAD.size + n
        laces = media[at + HEAD.size : body]
        stop = body + sum(laces)
        if stop > end:
            raise OggError(f"the page at byte {at} is cut off")
        if page_crc(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : stop]) != crc:
            raise OggError(f"the page at byte {at} has a wrong checksum")
        yield flags, granule, serial, sequence, laces, body
        at = stop


def demultiplex(media: bytes) -> dict[int, list[tuple[bytes, int]]]:
    """The packets of each logical stream by serial, with the stream's granule position at the end of each.

    Packets are put together from their lacing values, over pages where a packet is continued. A
    page's granule position is the end of the last packet that ends on it; those before it end
    earlier by the samples (bytes) that follow them. Page sequence numbers must have no gap,
    continued flags must agree with what the page before left open, a stream must end with a page
    that says so, and nothing of it may come after that.
    """
    out: dict[int, list[tuple[bytes, int]]] = {}
    left: dict[int, bytearray | None] = {}
    due: dict[int, int] = {}
    over: set[int] = set()
    for flags, granule, serial, sequence, laces, at in pages(media):
        if serial not in out:
            if not flags & FIRST:
                raise OggError(f"stream {serial} lacks its first page")
            out[serial], left[serial], due[serial] = [], None, 0
        elif flags & FIRST:
            raise OggError(f"stream {serial} begins twice")
        if serial in over:
            raise OggError(f"stream {serial} has a page after its last one")
        if sequence != due[serial]:
            raise OggError(f"stream {serial} lacks page {due[serial]}")
        due[serial] += 1
        part = left[serial]
        if bool(flags & CONTINUED) != (part is not None):
            raise OggError(f"page {sequence} of stream {serial} does not continue the one before")
        part = bytearray() if part is None else part
        open_, ended, run = bool(flags & CONTINUED), [], 0
        for lace in laces:
            run += lace
            open_ = lace == LACE
            if not open_:
                part += media[at : at + run]
                at += run
                run = 0
                ended.append(bytes(part))
                part = bytearray()
        if run or open_:
            part += media[at : at + run]
        left[serial] = part if open_ else None
        if ended and granule == NO_GRANULE:
            raise OggError(f"packets end on page {sequence} of stream {serial}, which has no granule position")
        end, timed = granule, []
        for k, packet in enumerate(reversed(ended)):
            timed.append((packet, end))
            end -= 0 if granule == 0 else len(packet)  # headers take no time
        out[serial] += reversed(timed)
        if flags & LAST:
            over.add(serial)
    if any(x is not None for x in left.values()):
        raise OggError("a stream ends within a packet")
    if missing := out.keys() - over:
        raise OggError(f"stream {min(missing)} has no last page")
    return out


def decode(media: bytes) -> tuple[bytes, dict[str, int]]:
    """The samples in order of time, and counts: streams, packets, samples a second and microseconds.

    A packet plays from its granule position less its samples. In a stream the packets must follow
    each other without a gap; its comment says which turns it has, and so what comes between them.
    """
    turns: list[tuple[int, int, bytes]] = []
    rate, seen, total = 0, [], None
    streams = demultiplex(media)
    for serial, packets in streams.items():
        if len(packets) < 2 or not packets[0][0].startswith(PCM_MAGIC) or not packets[1][0].startswith(COMMENT_MAGIC + b"STREAM="):
            raise OggError(f"stream {serial} lacks its headers")
        if len(packets[0][0]) != PCM_HEAD.size:
            raise OggError(f"stream {serial} has a header of the wrong size")
        kind, rate = PCM_HEAD.unpack(packets[0][0])[3:5]
        size = PCM_HEAD.unpack(packets[0][0])[7]
        turn, _, count = packets[1][0][len(COMMENT_MAGIC) + 7 :].partition(b"/")
        if kind != PCM_U8 or not size or not turn.isdigit() or not count.isdigit():
            raise OggError(f"stream {serial} is not of unsigned 8-bit samples in turns")
        seen.append(int(turn))
        total = int(count) if total in (None, int(count)) else -1
        at = 0
        for data, end in packets[2:]:
            if end - len(data) != at or at % size:
                raise OggError(f"the packet at sample {end - len(data)} of stream {serial} does not follow sample {at}")
            turns.append((at // size, int(turn), data))
            at = end
    if sorted(seen) != list(range(total or 0)):
        raise OggError("a logical stream is missing")
    turns.sort(key=lambda x: x[:2])
    samples = b"".join(d for *_, d in turns)
    return samples, {"streams": len(streams), "packets": len(turns), "rate": rate, "us": len(samples) * 1_000_000 // max(rate, 1)}


def features(samples: bytes, facts: dict[str, int]) -> str:
    """Streams, packets, duration, mean, root mean square about it, and zero crossings of the samples."""
    x = np.frombuffer(samples, np.uint8)
    hist = np.bincount(x, minlength=256)
    level = np.arange(256)
    n, s, q = len(x), int((hist * level).sum()), int((hist * level * level).sum())
    above = x >= 128
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    spread = ((q * n - s * s) / n**2) ** 0.5 if n else 0.0
    return f"streams={facts['streams']};packets={facts['packets']};us={facts['us']};mean={s / n if n else 0.0:.6f};rms={spread:.6f};crossings={crossings}"


def padded(text: str | None) -> tuple[bytes, int]:
    """The text's UTF-8 bytes with zeros up to a positive multiple of BLOCK, and their number before."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % BLOCK if raw else BLOCK), len(raw)


def with_media(df: DataFrame, text: str = "text", media: str = "media", n_bytes: str = "n_bytes") -> DataFrame:
    """Add each text's Ogg container and its unpadded bytes.

    Null and empty texts give a container of BLOCK zero samples. Equal texts give equal bytes. A text
    of any length is written whole; it and its container are in memory at once. Other columns pass through; columns named as the outputs are replaced.
    """
    keep = [c for c in df.columns if c not in (media, n_bytes)]
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(n_bytes, T.LongType()), T.StructField(media, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = 0
            for n in portions(pa.compute.binary_length(b.column(len(keep))).fill_null(0).to_pylist(), AT_ONCE):
                part = b.slice(k, n)
                k += n
                made = [padded(t) for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array([n for _, n in made], pa.int64()), pa.array([encode(p) for p, _ in made], pa.binary())],
                    names=schema.names,
                )

    return positional(src).mapInArrow(frugal(run), schema)


def read_media(df: DataFrame, media: str = "media") -> DataFrame:
    """Replace the containers by what is read back from them.

    payload_bytes, payload_sha256, tail_crc32 (of the last BLOCK bytes), media_bytes,
    media_sha256, feature, ogg_error. A null or damaged container has an error and no other value.
    """
    keep = [c for c in df.columns if c != media]
    out = T.StructType().add("payload_bytes", "long").add("payload_sha256", "string").add("tail_crc32", "long").add("media_bytes", "long").add("media_sha256", "string").add("feature", "string").add("ogg_error", "string")
    schema = T.StructType([*[df.schema[c] for c in keep], *out.fields])

    def one(data: bytes | None) -> tuple:
        try:
            if data is None:
                raise OggError("no container")
            samples, facts = decode(data)
        except OggError as e:
            return (None,) * 6 + (str(e),)
        return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:]), len(data), hashlib.sha256(data).hexdigest(), features(samples, facts), None

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*[one(x.as_py()) for x in b.column(len(keep))], strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=schema.names)

    return positional(df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{media}`"))).mapInArrow(frugal(run), schema)


def op1_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as an Ogg recording, read back and described."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_media(with_media(docs).select("doc_id", "n_bytes", "media")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "ogg_error")
