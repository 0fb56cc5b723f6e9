import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loomsift.llm import ogg
from loomsift.llm.ogg import OggError, decode, demultiplex, encode, page_crc

from .cases import clashing, documents, empty


def crc(data):
    c = 0
    for x in data:
        c ^= x << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else c << 1 & 0xFFFFFFFF
    return c


def test_checksum():
    for n in (0, 1, 27, 300):
        data = os.urandom(n)
        assert page_crc(data) == crc(data)


@pytest.mark.parametrize("packet", [1, 254, 255, 256, 4096, 65000])
@pytest.mark.parametrize("streams", [1, 2, 3])
def test_round_trip(packet, streams):
    for n in (64, 255 * 3, 255 * 255 + 64, 70_016) if packet > 200 else (64, 640):
        data = os.urandom(n)
        media = encode(data, packet=packet, streams=streams)
        back, facts = decode(media)
        assert back == data and facts["streams"] == streams and facts["us"] == n * 1_000_000 // ogg.RATE
        assert [p for ps in demultiplex(media).values() for p, _ in ps[2:]] == [data[i : i + packet] for k in range(streams) for i in range(k * packet, n, streams * packet)]


def test_damage():
    media = encode(os.urandom(20_000))
    rng = random.Random(0)
    for _ in range(300):
        i = rng.randrange(len(media))
        with pytest.raises(OggError):
            decode(media[:i] + bytes([media[i] ^ 1 << rng.randrange(8)]) + media[i + 1 :])
    for cut in (1, 5000, len(media) - 1):
        with pytest.raises(OggError):
            decode(media[:cut])
    pages = [i for i in range(len(media)) if media[i : i + 4] == b"OggS"]
    with pytest.raises(OggError):  # a page is missing
        decode(media[: pages[5]] + media[pages[6] :])


def page_starts(media):
    return [i for i in range(len(media)) if media[i : i + 4] == b"OggS"]


@pytest.mark.parametrize("n", [64, 4096, 20_000, 200_000])
def test_a_cut_at_any_page_is_seen(n):
    media = encode(os.urandom(n))
    for at in page_starts(media)[1:]:
        with pytest.raises(OggError):
            decode(media[:at])


def test_nothing_follows_a_last_page():
    media = encode(bytes(range(256)) * 64)
    serial = int.from_bytes(media[14:18], "little")
    more = ogg.StreamWriter(serial)
    more.sequence = max(p[3] for p in ogg.pages(media) if p[2] == serial) + 1
    with pytest.raises(OggError, match="after its last"):
        decode(media + more.packets([b"x" * 64], [99_999], last=True)[0])
    with pytest.raises(OggError, match="no last page"):
        decode(media + b"".join(ogg.StreamWriter(7).packets([b"x" * 64], [64], first=True)))
    with pytest.raises(OggError):  # a whole stream is missing
        decode(b"".join(media[s:e] for s, e in zip(page_starts(media), [*page_starts(media)[1:], len(media)], strict=True) if media[s + 14 : s + 18] == media[14:18]))


def test_times_are_counted_back_from_the_page():
    w = ogg.StreamWriter(5)
    packets = [b"a" * 100, b"b" * 300, b"", b"c" * 255, b"d" * 1000]
    out = w.packets([b"head"], [0], first=True)
    out += w.packets(packets, [100, 400, 400, 655, 1655], segments=4, last=True)
    assert demultiplex(b"".join(out))[5] == [(b"head", 0), *zip(packets, [100, 400, 400, 655, 1655], strict=True)]
    laces = [p[4] for p in ogg.pages(b"".join(out))][1:]
    assert [len(x) for x in laces] == [4, 4, 2]  # three packets on the first page; the last one goes on over three
    assert [p[1] for p in ogg.pages(b"".join(out))][1:] == [400, 655, 1655]
    w = ogg.StreamWriter(5)
    with pytest.raises(OggError, match="no granule position"):
        demultiplex(w.page(ogg.FIRST, 0, b"\x01", b"h") + w.page(ogg.LAST, -1, b"\x01", b"x"))


def test_pages_hold_several_packets_and_packets_go_on():
    media = encode(os.urandom(60_000))
    kinds = [(p[0] & ogg.CONTINUED, sum(x < 255 for x in p[4])) for p in ogg.pages(media)]
    assert any(c for c, _ in kinds) and any(n >= 2 for _, n in kinds)
    assert sum(len(ps) - 2 for ps in demultiplex(media).values()) == -(-60_000 // 4096)


def test_operator(spark):
    docs = documents(spark)
    out = ogg.read_media(ogg.with_media(docs).select("doc_id", "text", "n_bytes", "media")).collect()
    assert len(out) == docs.count()
    for r in out:
        raw = (r["text"] or "").encode()
        pay = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert r["ogg_error"] is None and r["n_bytes"] == len(raw) and r["payload_bytes"] == len(pay)
        assert r["tail_crc32"] == zlib.crc32(pay[-64:]) and r["payload_sha256"] == hashlib.sha256(pay).hexdigest()
        media = encode(pay)
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        told = dict(x.split("=") for x in r["feature"].split(";"))
        mean = sum(pay) / len(pay)
        assert told["streams"] == "2" and told["packets"] == str(-(-len(pay) // 4096)) and told["us"] == str(len(pay) * 125)
        assert float(told["mean"]) == pytest.approx(mean, abs=1e-5) and float(told["rms"]) == pytest.approx((sum((x - mean) ** 2 for x in pay) / len(pay)) ** 0.5, abs=1e-5)
        assert told["crossings"] == str(sum((x >= 128) != (y >= 128) for x, y in zip(pay, pay[1:])))
    same = [r for r in out if r["doc_id"] in (0, 1)]
    assert len({(r["media_sha256"], r["feature"]) for r in same}) == 1
    assert ogg.read_media(ogg.with_media(clashing(docs))).count() == docs.count()
    assert ogg.read_media(ogg.with_media(empty(docs))).count() == 0
    bad = spark.createDataFrame([(None,), (bytearray(b"x"),)], "media binary")
    assert all(r["ogg_error"] and r["payload_bytes"] is None for r in ogg.read_media(bad).collect())
    assert ogg.with_media(docs.withColumn("media", F.lit(1))).schema["media"].dataType.typeName() == "binary"
