import io
import random

import pytest

from loomsift.sources import warc
from loomsift.sources.warc import Blocks, format_record, gzip_member, members


def member(i, body, level=6):
    return gzip_member(format_record({"WARC-Type": "resource", "WARC-Record-ID": f"<{i}>"}, body), level)


def owned(data, cuts, block=1 << 20):
    return [(at, n, error) for a, b in zip(cuts, cuts[1:], strict=False) for at, n, _, error in members(Blocks(io.BytesIO(data), len(data), block), a, b)]


def bounds(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, len(p), None))
        at += len(p)
    return out


@pytest.mark.parametrize("block", [1 << 20, 777])
def test_ranges_own_what_begins_in_them(block):
    rng = random.Random(2)
    parts = [member(i, rng.randbytes(rng.randrange(5000)) + b"\x1f\x8b\x08" * 3, 0 if i % 2 else 6) for i in range(80)]
    data = b"".join(parts)
    for _ in range(15):
        cuts = sorted({0, len(data), *(rng.randrange(len(data)) for _ in range(7))})
        assert owned(data, cuts, block) == bounds(parts)


def test_an_archive_inside_a_record_is_none_of_the_outer_one():
    rng = random.Random(3)
    inner = b"".join(member(f"in{i}", rng.randbytes(3000)) for i in range(60))  # longer than a stored block
    parts = [member("a", b"x" * 100), member("nested", inner, 0), member("b", inner[:9000]), *(member(f"c{i}", rng.randbytes(900)) for i in range(5))]
    data = b"".join(parts)
    assert b"<in0>" in data  # stored as it is
    for cuts in ([0, len(data)], list(range(0, len(data), 5000)) + [len(data)], list(range(0, len(data), 70_001)) + [len(data)]):
        assert owned(data, cuts) == bounds(parts)


def test_damage_is_told_and_passed_over():
    rng = random.Random(4)
    parts = [member(i, rng.randbytes(2000)) for i in range(120)]
    data = bytearray(b"".join(parts))
    whole = bounds(parts)
    for k in (3, 50):
        data[whole[k][0] + whole[k][1] - 3] ^= 1  # in the trailer
    data[whole[80][0]] = 0  # no gzip magic
    data = bytes(data)[:-10]
    for cuts in ([0, len(data)], [0, 20_000, 100_500, 101_000, 170_000, len(data)]):
        got = owned(data, cuts)
        assert [x[:2] for x in got[:-1]] == [x[:2] for x in whole[:-1]]
        assert [i for i, x in enumerate(got) if x[2]] == [3, 50, 80, 119]
    assert owned(b"".join(parts) + b"\0" * 3_000_000, [0, 10**9]) == whole


def test_long_archives_take_linear_time():
    import time

    part = member(0, b"x" * 900 + random.Random(1).randbytes(900))
    took = []
    for n in (2000, 8000):
        start = time.process_time()
        assert len(owned(part * n, [0, len(part) * n])) == n
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 0.5


def test_wrong_digests_and_heads(spark, tmp_path):
    good = {"WARC-Type": "response", "WARC-Target-URI": "u"}
    data = gzip_member(format_record(good | {"WARC-Payload-Digest": "sha1:AAAA"}, b"x")) + gzip_member(b"WARC/1.0\r\nno colon\r\n\r\n") + gzip_member(format_record(good, b"y")) + gzip_member(format_record(good | {"WARC-Type": "revisit", "WARC-Payload-Digest": "sha1:1"}, b""))
    (tmp_path / "x.warc.gz").write_bytes(data)
    rows = sorted(warc.read_warc(spark, str(tmp_path / "x.warc.gz"), None, 40).collect(), key=lambda r: r["offset"])
    assert [r["error"] for r in rows] == ["the payload does not have its digest", "a header line has no colon", None, "the revisit's digest or length cannot be read"]
