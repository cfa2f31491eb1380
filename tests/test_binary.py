"""Binary geometries against a plain encoder, whole and broken ones in one batch."""

import random
import struct

import pyarrow as pa
import pytest

from placeforge.operators import kernels


def random_geometry(r, kind=None):
    kind = kind or r.choice([1, 2, 3, 4, 5, 6])
    line = lambda: [(r.uniform(-180, 180), r.uniform(-90, 90)) for _ in range(r.randint(0, 5))]
    if kind == 1:
        return kind, [[[(r.uniform(-180, 180), r.uniform(-90, 90))]]]
    if kind == 2:
        return kind, [[line()]]
    if kind == 3:
        return kind, [[line() for _ in range(r.randint(0, 3))]]
    return kind, [random_geometry(r, kind - 3)[1][0] for _ in range(r.randint(0, 4))]


def encode(r, kind, parts, end, srid, z, m):
    code = kind | (0x20000000 if srid else 0) | (0x80000000 if z else 0) | (0x40000000 if m else 0)
    out = struct.pack(end + "BI", end == "<", code) + (struct.pack(end + "I", 4326) if srid else b"")
    count = lambda n: struct.pack(end + "I", n)
    run = lambda line: b"".join(struct.pack(f"{end}{2 + z + m}d", *p, *([7.0] * (z + m))) for p in line)
    if kind == 1:
        return out + run(parts[0][0])
    if kind == 2:
        return out + count(len(parts[0][0])) + run(parts[0][0])
    if kind == 3:
        return out + count(len(parts[0])) + b"".join(count(len(q)) + run(q) for q in parts[0])
    return out + count(len(parts)) + b"".join(encode(r, kind - 3, [p], r.choice("<>"), False, z, m) for p in parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_columns_of_binary_geometries(seed):
    r = random.Random(seed)
    values, expected = [], []
    for i in range(1500):
        kind, parts = random_geometry(r)
        whole = encode(r, kind, parts, r.choice("<>"), r.random() < 0.5, r.random() < 0.3, r.random() < 0.2)
        broken = {
            3: whole[: r.randint(0, len(whole) - 1)], 4: whole + b"x", 5: None, 6: bytes(r.randrange(256) for _ in range(r.randint(0, 60))),
            7: whole[:1] + struct.pack("<I" if whole[0] else ">I", 9) + whole[5:], 8: b"\x07" + whole[1:], 9: b"\x01\x02\x00\x00\x00\xff\xff\xff\xff",
        }.get(i % 13, whole)
        values.append(broken)
        expected.append((kernels.WKB_TYPES[kind], parts) if broken is whole else None)
    found, good = kernels._read_ewkb(pa.array(values, pa.binary()))
    shape = lambda g: g and (g["gtype"], [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in g["parts"]])
    assert [shape(g) for g in found.to_pylist()] == expected
    assert good.tolist() == [e is not None for e in expected]
    part, _ = kernels._read_ewkb(pa.array(values, pa.binary())[100:200])
    assert part.to_pylist() == found[100:200].to_pylist()
    assert kernels._read_ewkb(pa.array([], pa.binary()))[0].to_pylist() == []
