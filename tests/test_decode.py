"""Decoder: the reference's decoder test inputs, error order, routing, text source."""

import pytest
from pyspark.sql import functions as F

from helpers import addr_topic, addr_word, int_topic, meta_df, raw_df, raw_log
from tidepool.operators import decode as D
from tidepool.sources.logs import parse_json_lines
from tidepool import schemas as S

POOL1 = "0x" + "11" * 20
POOL9 = "0x" + "99" * 20
A, Bb, C = "0x" + "aa" * 20, "0x" + "bb" * 20, "0x" + "cc" * 20
SENDER, RECIP = "0x" + "22" * 20, "0x" + "33" * 20


@pytest.fixture(scope="module")
def meta(spark):
    return meta_df(spark, [(56, POOL1, A, Bb, 2500, 60), (56, POOL9, A, Bb, 500, 10)])


def _decode(spark, meta, rows, routes=None):
    return D.decode_logs(raw_df(spark, rows), meta, routes).collect()


def test_swap(spark, meta):
    rows = [raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [-1000, 2000, 123456789, 987654321, -15], POOL1)]
    r = _decode(spark, meta, rows)[0]
    assert r.outcome == "decoded" and r.event_name == "Swap"
    d = r.decoded
    assert (d.amount0, d.amount1, d.tick, d.sqrt_price_x96, d.liquidity) == ("-1000", "2000", -15, "123456789", "987654321")
    assert (d.sender, d.recipient) == (SENDER, RECIP)
    assert (r.pool_meta.token0, r.pool_meta.token1, r.pool_meta.fee, r.pool_meta.tick_spacing) == (A, Bb, 2500, 60)
    assert r.raw.topic0 == D.SWAP.topic0


def test_mint_burn_collect(spark, meta):
    rows = [
        raw_log("Mint", [addr_topic(Bb), int_topic(-120), int_topic(120)], [addr_word(A), 5000, 100, 200], POOL9),
        raw_log("Burn", [addr_topic(Bb), int_topic(-60), int_topic(60)], [7000, 300, 400], POOL9, log_index=2),
        raw_log("Collect", [addr_topic(Bb), int_topic(-10), int_topic(10)], [addr_word(C), 900, 1000], POOL9,
                log_index=3),
    ]
    out = {r.event_name: r for r in _decode(spark, meta, rows)}
    m, b, c = out["Mint"].decoded, out["Burn"].decoded, out["Collect"].decoded
    assert (m.owner, m.sender, m.tick_lower, m.tick_upper, m.amount, m.amount0, m.amount1) == \
        (Bb, A, -120, 120, "5000", "100", "200")
    assert (b.owner, b.tick_lower, b.tick_upper, b.amount, b.amount0, b.amount1) == (Bb, -60, 60, "7000", "300", "400")
    assert (c.owner, c.recipient, c.tick_lower, c.tick_upper, c.amount0, c.amount1) == (Bb, C, -10, 10, "900", "1000")
    assert out["Mint"].pool_meta.fee == 500


@pytest.mark.parametrize("row,error", [
    (raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2, 3, 4, 2 ** 23], POOL1), "int24 overflow: 8388608"),
    (raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2, 3, 4, -(2 ** 23) - 1], POOL1),
     "int24 overflow: -8388609"),
    (raw_log("Swap", [addr_topic(SENDER)], [1, 2, 3, 4, 5], POOL1), "expected 3 topics, got 2"),
    (raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2, 3, 4, 5], "0x12"),
     "invalid pool address: 0x12"),
    (raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2], POOL1),
     "unpack Swap: abi: cannot marshal in to go type: length insufficient 64 require 96"),
    (raw_log("Burn", ["0xzz", int_topic(1), int_topic(2)], [1, 2, 3], POOL9), "invalid topic: invalid hex string"),
    (raw_log("Mint", [addr_topic(Bb), int_topic(2 ** 23), int_topic(1)], [addr_word(A), 1, 2, 3], POOL9),
     "int24 overflow: 8388608"),
])
def test_errors(spark, meta, row, error):
    r = _decode(spark, meta, [row])[0]
    assert (r.outcome, r.error) == ("failed", error)


def test_error_order_address_before_arity(spark, meta):
    row = raw_log("Swap", [addr_topic(SENDER)], [1], "bad")
    assert _decode(spark, meta, [row])[0].error == "invalid pool address: bad"


def test_skipped_and_missing_topics(spark, meta):
    unknown = raw_log("Swap", [], [], POOL1, topic0="0x" + "ab" * 32)
    empty = (56, 1, "0xabc", "0xdef", 0, 1, POOL1, [], "0x", False, 1, "")
    out = _decode(spark, meta, [unknown, empty])
    assert [(r.outcome, r.error) for r in out] == [("skipped", None), ("failed", "missing topic0")]


def test_upper_case_topic_and_extra_words(spark, meta):
    row = raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, -2, 3, 4, 5, 6, 7], POOL1,
                  topic0=D.SWAP.topic0.upper().replace("0X", "0x"))
    r = _decode(spark, meta, [row])[0]
    assert r.outcome == "decoded" and r.decoded.amount1 == "-2"


def test_routing_map():
    fork = "0x" + "12" * 32
    routes = D.routing_map({fork: " SWAP ", "": "mint"})
    assert routes[fork] == "Swap" and "" not in routes
    with pytest.raises(ValueError):
        D.routing_map({fork: "transfer"})


def test_missing_pool_meta(spark, meta):
    other = "0x" + "44" * 20
    row = raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2, 3, 4, 5], other)
    assert _decode(spark, meta, [row])[0].error == f"pool meta not found: {other}"


def test_json_lines_dead_letter(spark, meta):
    lines = spark.createDataFrame([('{"chain_id": 56, "block_number": 7, "topics": []}',), ("not json",),
                                   ("   ",), ("null",)], "value string")
    logs = parse_json_lines(lines, S.RAW_LOG)
    dec = D.decode_logs(logs, meta)
    errs = D.decode_errors(dec).orderBy("block_number", "error").collect()
    assert len(errs) == 3
    assert {e.error for e in errs} == {"missing topic0", "invalid json line"}
    bad = [e for e in errs if e.error == "invalid json line"][0]
    assert (bad.chain_id, bad.tx_hash, bad.topic0) == (0, "", "")
    assert D.decode_counters(dec).where(F.col("counter") == "total").first().value == 3


def test_layouts_as_a_table_give_what_the_fixed_decoder_gives(spark, meta):
    """The same logs, faults included, by branches and by the spec table."""
    good = [raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [-1000, 2000, 2 ** 160 - 1, 987654321, -15], POOL1),
            raw_log("Mint", [addr_topic(Bb), int_topic(-120), int_topic(120)], [addr_word(A), 5000, 100, 2 ** 255], POOL9, log_index=2),
            raw_log("Swap", [addr_topic(SENDER)], [1, 2, 3, 4, 5], POOL1, log_index=3),
            raw_log("Swap", [addr_topic(SENDER), "0x" + "ab" * 33], [1, 2, 3, 4, 5], POOL1, log_index=4),
            raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2], POOL1, log_index=5),
            raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [], POOL1, log_index=6),
            raw_log("Swap", [addr_topic(SENDER), addr_topic(RECIP)], [1, 2, 3, 4, 2 ** 23], POOL1, log_index=7),
            raw_log("Burn", ["0xzz", int_topic(-120), int_topic(120)], [1, 2, 3], POOL9, log_index=8),
            raw_log("Swap", [], [], POOL1, log_index=9, topic0="0x" + "ab" * 32)]
    fixed = {r.log_index: r for r in _decode(spark, meta, good)}
    by_spec = {r.log_index: r for r in D.decode_by_spec(raw_df(spark, good), D.spec_table(spark)).collect()}
    assert by_spec.keys() == fixed.keys()
    for i, r in fixed.items():
        assert (by_spec[i].outcome, by_spec[i].error, by_spec[i].event_name) == (r.outcome, r.error, r.event_name), i
        if r.outcome == "decoded":
            for name, text in by_spec[i].fields.items():
                assert str(r.decoded[name]) == text


def test_a_new_kind_is_a_new_row(spark):
    note = D.EventSpec("Note", "0x" + "77" * 32, (("who", "address"),), (("x", "int256"), ("t", "int24"), ("y", "uint"), ("z", "uint"), ("u", "address"), ("v", "uint")))
    logs = raw_df(spark, [raw_log("Swap", [addr_topic(SENDER)], [-7, -2, 2 ** 256 - 1, 0, addr_word(A), 9], POOL1, topic0=note.topic0)])
    assert D.decode_by_spec(logs, D.spec_table(spark)).first().outcome == "skipped"
    r = D.decode_by_spec(logs, D.spec_table(spark, (note, *D.EVENTS.values()))).first()
    assert r.fields == {"who": SENDER, "x": "-7", "t": "-2", "y": str(2 ** 256 - 1), "z": "0", "u": A, "v": "9"}


def test_layouts_are_broadcast_and_only_kept_rows_converted(spark):
    logs = raw_df(spark, [raw_log("Swap", [addr_topic("0x" + "22" * 20)] * 2, [-1000, 2000, 3, 4, -15], "0x" + "11" * 20)])
    kept = D.decode_by_spec(logs, D.spec_table(spark)).where("event_name = 'Swap' AND outcome = 'decoded'")
    assert kept.first().fields["amount0"] == "-1000"
    plan = kept.select("fields")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "SortMergeJoin" not in plan
    assert plan.index("ArrowEvalPython") < plan.index("Filter")


def test_only_the_fields_read_are_converted(spark):
    good = raw_log("Swap", [addr_topic("0x" + "aa" * 20)] * 2, [-1000, 2000, 3, 4, 5], POOL1)
    bad = raw_log("Swap", [addr_topic("0x" + "aa" * 20)] * 2, [-1000, 2000, 3, 4, 1 << 23], POOL1, log_index=2)
    meta = meta_df(spark, [(56, POOL1, "0xaa", "0xbb", 2500, 60)])
    rows = D.decode_logs(raw_df(spark, [good, bad]), meta, fields=("amount0", "amount1")).orderBy("log_index").collect()
    assert [r.outcome for r in rows] == ["decoded", "failed"] and rows[1].error.startswith("int24 overflow")
    got = {k: v for k, v in rows[0].decoded.asDict().items() if v is not None}
    assert got == {"amount0": "-1000", "amount1": "2000"}
