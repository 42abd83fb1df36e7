"""Checksum text (F11) and the driver contract."""

from tidepool.functions.checksum import _sponge256, checksum_addresses, keccak256, to_checksum

VECTORS = ["0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed", "0xfB6916095ca1df60bB79Ce92cE3Ea74c37c5d359",
           "0xdbF03B407c01E7cD3CBea99509d93f8DDDC8C6FB", "0xD1220A0cf47c7B9Be7A2E6BA89F429762e7b9aDb"]


def test_keccak_and_checksum():
    import hashlib
    assert keccak256(b"").hex().startswith("c5d2460186f7233c")
    for n in (0, 1, 135, 136, 137, 300):
        assert _sponge256(b"z" * n, 0x06) == hashlib.sha3_256(b"z" * n).digest()
    assert all(to_checksum(v.lower()) == v for v in VECTORS)


def test_checksum_addresses_job(spark):
    df = spark.createDataFrame([(v.lower(), VECTORS[0].lower()) for v in VECTORS], "a string, b string")
    got = checksum_addresses(df, ["a", "b"]).collect()
    assert sorted(r.a for r in got) == sorted(VECTORS) and {r.b for r in got} == {VECTORS[0]}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"pool_address", "window_start", "swap_count", "volume0", "fee0"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 25
