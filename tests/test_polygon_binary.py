"""Polygon binary that ends too early, or announces more than it holds."""
import struct

import pytest

from hexatlas.sources import polygons

RING = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
GOOD = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 4) + b"".join(struct.pack("<dd", *p) for p in RING)
BAD = [b"", b"\x01", bytes.fromhex("0103000000"), GOOD[:9], GOOD[:12], GOOD[:13], GOOD[:14], GOOD[:-1], GOOD[:-16],
       struct.pack("<BII", 1, 3, 2 ** 32 - 1) + GOOD[9:], struct.pack("<BIII", 1, 3, 1, 2 ** 32 - 1) + GOOD[13:],
       struct.pack("<BIII", 1, 3, 1, 2 ** 31 - 1), struct.pack("<BII", 1, 3, 2) + GOOD[9:]]


def test_truncated_binary_is_put_aside(spark):
    rows = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([GOOD, struct.pack("<BII", 1, 3, 0), *BAD])] + [(99, None)], "i int, wkb binary")
    got = {r["i"]: r["rings"] for r in polygons.read_wkb(rows, on_error="null").select("i", "rings").collect()}
    assert [[tuple(p) for p in ring] for ring in got[0]] == [RING] and got[1] == []
    assert all(got[i + 2] is None for i in range(len(BAD))) and got[99] is None


@pytest.mark.parametrize("at", [2, 5, 8])
def test_truncated_binary_raises_with_its_place(spark, at):
    rows = spark.createDataFrame([(bytearray(BAD[at]),)], "wkb binary")
    with pytest.raises(Exception, match="Invalid polygon binary at byte"):
        polygons.read_wkb(rows).select("rings").collect()
