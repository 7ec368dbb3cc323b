import ipaddress
import random

import pytest
from millrace.operators import addresses
from pyspark.sql import functions as F


def parsed(text):
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(a) if a.version == 6 else 0xFFFF << 32 | int(a)


def texts():
    rng = random.Random(6)
    out = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::8", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "fe80::1:2", "255.255.255.255", "0.0.0.0"]
    out += ["", "1", "1.2.3", "1.2.3.256", "01.2.3.4", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "12345::", "g::1", "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.999", ":", "1::2:3:4:5:6:7:8", None]
    for _ in range(150):
        a = rng.getrandbits(128) & rng.choice([-1, ~(0xFFFFFFFFFFFF << 32), 0xFFFF, (1 << 64) - 1])
        out += [str(ipaddress.IPv6Address(a)), ipaddress.IPv6Address(a).exploded.upper(), str(ipaddress.IPv4Address(a & 0xFFFFFFFF))]
    return out


def test_digits_equal_the_standard_library(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "t string")
    for r in df.select("t", addresses.address_digits(F.col("t")).alias("d")).collect():
        want = parsed(r.t) if r.t is not None else None
        assert r.d == (None if want is None else f"{want:032x}"), r


def test_longest_prefix_equals_brute_force(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(128) for _ in range(6)] + [0xFFFF << 32 | rng.getrandbits(32) for _ in range(4)]
    nets = {}
    for i in range(120):
        bits = rng.randrange(96, 129) if (b := rng.choice(base)) >> 32 == 0xFFFF else rng.randrange(129)
        net = b >> (128 - bits) << (128 - bits) if bits else 0
        nets.setdefault((bits, net), i)
    rows = [(f"{ipaddress.IPv4Address(n & 0xFFFFFFFF)}/{b - 96}" if b >= 96 and n >> 32 == 0xFFFF and i % 2 else f"{ipaddress.IPv6Address(n)}/{b}", f"n{i:03}") for (b, n), i in nets.items()]
    ips = [b ^ rng.getrandbits(rng.randrange(1, 129)) for b in base for _ in range(20)]
    names = [str(ipaddress.IPv6Address(a)) for a in ips] + ["no", None]
    df = spark.createDataFrame([(t, "x") for t in names], "ip string, other string")
    out = addresses.lookup_prefix(df, "ip", spark.createDataFrame(rows, "cidr string, name string"), "cidr", ["name"], strict=True).collect()
    assert len(out) == len(names)
    for r in out:
        hits = [(b, f"n{i:03}") for (b, n), i in nets.items() if r.ip not in ("no", None) and int(ipaddress.IPv6Address(r.ip)) >> (128 - b) == n >> (128 - b)]
        assert (r.name, r.found) == ((max(hits)[1], True) if hits else (None, False))


@pytest.mark.parametrize("bad,strict", [("10.0.0.0/33", False), ("::/129", False), ("10.0.0/8", False), ("10.0.0.0/x", False), (None, False), ("10.0.0.1/8", True)])
def test_what_is_no_prefix_is_an_error(spark, bad, strict):
    df = spark.createDataFrame([("10.0.0.1",)], "ip string")
    with pytest.raises(Exception, match="not a prefix"):
        addresses.lookup_prefix(df, "ip", spark.createDataFrame([(bad, "x")], "cidr string, name string"), "cidr", ["name"], strict).collect()
