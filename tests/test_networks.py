"""Addresses in nested networks against every pair, by lookup and by sweep."""

import random

import pytest

from millrace.errors import QueryError
from millrace.operators import joins, series


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    nets = [(10 << 24, 8)] + [((10 << 24) + rng.randrange(1 << 24), rng.choice([9, 12, 16, 20, 24, 28, 32])) for _ in range(60)]
    nets += [(rng.randrange(1 << 32), rng.choice([2, 8, 16, 24])) for _ in range(30)] + [(0, 1), ((1 << 32) - 1, 32), nets[5], nets[5]]
    cidrs = [(i, f"{a >> 24}.{a >> 16 & 255}.{a >> 8 & 255}.{a & 255}/{p}") for i, (a, p) in enumerate(nets)]
    ips = [(10 << 24) + rng.randrange(1 << 24) for _ in range(900)] + [rng.randrange(1 << 32) for _ in range(100)] + [0, (1 << 32) - 1, 10 << 24, 11 << 24]
    want = sorted((ip, i) for ip in ips for i, (a, p) in enumerate(nets) if ip >> (32 - p) == a >> (32 - p))
    ranges = joins.networks(spark.createDataFrame(cidrs, "net int, cidr string"), "cidr")
    return spark.createDataFrame([(ip,) for ip in ips], "ip long"), ranges, want, ips


@pytest.mark.parametrize("few, chunk", [(50_000, 100_000), (0, 100_000), (0, 64)])
def test_every_network_of_every_address(tables, monkeypatch, few, chunk):
    monkeypatch.setattr(series, "CHUNK", chunk)
    addresses, ranges, want, _ = tables
    got = joins.ip_range_join(addresses, "ip", ranges, few=few)
    assert sorted((r["ip"], r["net"]) for r in got.collect()) == want


def test_left_keeps_addresses_outside(tables):
    addresses, ranges, want, ips = tables
    rows = joins.ip_range_join(addresses, "ip", ranges.where("prefix > 8"), "left", few=0).collect()
    assert {r["ip"] for r in rows} == set(ips) and any(r["net"] is None for r in rows)


def test_no_networks(tables):
    with pytest.raises(QueryError):
        joins.ip_range_join(tables[0], "ip", tables[1].limit(0))
