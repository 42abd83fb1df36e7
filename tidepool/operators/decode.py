"""Decode raw pool logs into typed events, with a dead-letter split.

One narrow pass, no shuffle: routing is a lookup in a literal map built from
the decoder spec (a handful of entries), pool metadata comes from a
size-checked broadcast join, and every field is a column expression over the
hex text.  Each row ends with an ``outcome`` of decoded / skipped / failed and
an ``error`` message chosen first-error-wins in the reference's order:
topic route -> pool address -> pool metadata -> topic count -> topic hex ->
data hex -> word count -> int24 range (P15).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import schemas as S
from tidepool.functions import bigint as B
from tidepool.functions import hexcodec as H
from tidepool.functions.hexwords import word_array_text, words_text
from tidepool.operators.asof import asof_rows
from tidepool.operators.ingest import first_copy
from tidepool.plans.joins import bounded_broadcast, settled


@dataclass(frozen=True)
class EventSpec:
    """Layout of one event: indexed topics after topic0, then data words.

    Field kinds: address, int24, int256, uint (any unsigned width; wider
    than 64 bits is not range checked, as in the reference).
    """

    name: str
    topic0: str
    indexed: tuple
    data: tuple


# topic0 of the four pool events (keccak-256 of their ABI
# signatures) and their field layouts.
SWAP = EventSpec("Swap", "0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67",
                 (("sender", "address"), ("recipient", "address")),
                 (("amount0", "int256"), ("amount1", "int256"), ("sqrt_price_x96", "uint"),
                  ("liquidity", "uint"), ("tick", "int24")))
MINT = EventSpec("Mint", "0x7a53080ba414158be7ec69b987b5fb7d07dee101fe85488f0853ae16239d0bde",
                 (("owner", "address"), ("tick_lower", "int24"), ("tick_upper", "int24")),
                 (("sender", "address"), ("amount", "uint"), ("amount0", "uint"), ("amount1", "uint")))
BURN = EventSpec("Burn", "0x0c396cd989a39f4459b5fa1aed6a9a8dcdbc45908acfd67e028cd568da98982c",
                 (("owner", "address"), ("tick_lower", "int24"), ("tick_upper", "int24")),
                 (("amount", "uint"), ("amount0", "uint"), ("amount1", "uint")))
COLLECT = EventSpec("Collect", "0x70935338e69775456a85ddef226c395fb668b63fa0115f5f20610b388e6ca9c0",
                    (("owner", "address"), ("tick_lower", "int24"), ("tick_upper", "int24")),
                    (("recipient", "address"), ("amount0", "uint"), ("amount1", "uint")))
EVENTS = {e.name: e for e in (SWAP, MINT, BURN, COLLECT)}
MAX_TOPICS = 1 + max(len(e.indexed) for e in EVENTS.values())
MAX_WORDS = max(len(e.data) for e in EVENTS.values())

OUTCOME_DECODED, OUTCOME_SKIPPED, OUTCOME_FAILED = "decoded", "skipped", "failed"


def normalize_event_name(name: str) -> str:
    """trim + case-insensitive match against the four names, else "" (P7)."""
    key = (name or "").strip().lower()
    return next((n for n in EVENTS if n.lower() == key), "")


def routing_map(extra: dict[str, str] | None = None) -> dict[str, str]:
    """topic0 (lower case) -> event name: built-ins, then the extra map.

    A blank topic in ``extra`` is ignored; an unknown event name is an
    error; an extra entry may override a built-in one.
    """
    out = {e.topic0.lower(): e.name for e in EVENTS.values()}
    for topic0, name in (extra or {}).items():
        norm = normalize_event_name(name)
        if not norm:
            raise ValueError(f"unsupported event name in topic0 map: {name}")
        if not topic0:
            continue
        out[topic0.lower()] = norm
    return out


def route(topic0: Column, routes: dict[str, str]) -> Column:
    """Event name for a topic0, NULL when not routed (case-insensitive)."""
    m = F.create_map(*[F.lit(x) for kv in sorted(routes.items()) for x in kv])
    return F.try_element_at(m, F.lower(topic0))


def _by_name(name: Column, values: dict) -> Column:
    out = None
    for n, v in values.items():
        if v is None:
            continue
        out = F.when(name == n, v) if out is None else out.when(name == n, v)
    return out


def _field_sources():
    """For each decoded field and event: ('topic', i) or ('word', i) and its kind."""
    src: dict[str, dict[str, tuple]] = {}
    for e in EVENTS.values():
        for i, (f, kind) in enumerate(e.indexed):
            src.setdefault(f, {})[e.name] = ("topic", i + 1, kind)
        for i, (f, kind) in enumerate(e.data):
            src.setdefault(f, {})[e.name] = ("word", i, kind)
    return src


def _unpack_error(name: Column, n_bytes: Column) -> Column:
    """Word-count failure text of the ABI library."""
    need = _by_name(name, {n: F.lit(len(e.data)) for n, e in EVENTS.items()})
    have_words = idiv_floor(n_bytes, 32)
    return (F.when(n_bytes == 0, F.concat(F.lit("unpack "), name,
                                          F.lit(": abi: attempting to unmarshall an empty string "
                                                "while arguments are expected")))
            .when(have_words < need,
                  F.concat(F.lit("unpack "), name, F.lit(": abi: cannot marshal in to go type: length insufficient "),
                           n_bytes.cast("string"), F.lit(" require "),
                           ((have_words + 1) * 32).cast("string"))))


def idiv_floor(a: Column, b: int) -> Column:
    return B.idiv(a, b)


def decode_logs(logs: DataFrame, pool_meta: DataFrame, routes: dict[str, str] | None = None,
                pool_live: DataFrame | None = None, bucket_size: int = 10_000, fields: tuple = ()) -> DataFrame:
    """Classify and decode raw logs.

    ``logs`` has the RAW_LOG columns (an optional ``_parse_error`` column
    marks lines that were not valid JSON).  ``pool_meta``: chain_id,
    address, token0, token1, fee, tick_spacing.  ``pool_live`` (optional,
    J5): chain_id, address, block_number, liquidity, sqrt_price_x96, tick.
    ``fields``: the decoded fields that the caller reads, all by default; the
    others are NULL.  Every log is checked in full either way.

    Returns the log key columns plus event_name, outcome, error, decoded,
    pool_meta, raw.
    """
    routes = routes or routing_map()
    parse_err = F.col("_parse_error") if "_parse_error" in logs.columns else F.lit(None).cast("string")
    # NULL topics count as none whatever the session says about size(NULL).
    n_topics = F.when(F.col("topics").isNull(), F.lit(0)).otherwise(F.size("topics"))
    topic0 = F.get(F.col("topics"), 0)
    # Stage 0: route and locate words.
    data = F.coalesce(F.col("data"), F.lit(""))
    body = F.lower(H.hex_body(data))
    base = logs.select(
        "chain_id", "block_number", "block_hash", "tx_hash", "log_index", "address", "timestamp", "topics",
        F.col("data"),
        parse_err.alias("_perr"),
        n_topics.alias("_nt"),
        topic0.alias("_t0"),
        route(topic0, routes).alias("event_name"),
        H.hex_error(data).alias("_derr"),
        B.idiv(F.length(body), 2).alias("_nbytes"),
        *[H.word(body, i).alias(f"_w{i}") for i in range(MAX_WORDS)],
        *[F.get(F.col("topics"), i).alias(f"_t{i}") for i in range(1, MAX_TOPICS)],
    )
    # Pool metadata (J2): reduced to one row per (chain, pool), size-checked broadcast.
    meta = bounded_broadcast(first_copy(pool_meta.select(
        F.col("chain_id").alias("_mc"), H.address_key(F.col("address")).alias("_ma"),
        F.struct("token0", "token1", F.col("fee").cast("bigint").alias("fee"),
                 F.col("tick_spacing").cast("int").alias("tick_spacing")).alias("_meta")), ["_mc", "_ma"], [F.col("_meta")]))
    base = base.join(meta, (base["chain_id"] == meta["_mc"]) & (H.address_key(base["address"]) == meta["_ma"]),
                     "left").drop("_mc", "_ma")

    name = F.col("event_name")
    expected = _by_name(name, {n: F.lit(len(e.indexed) + 1) for n, e in EVENTS.items()})
    topic_errs = []
    for i in range(1, MAX_TOPICS):
        t = F.col(f"_t{i}")
        he = H.hex_error(t)
        n_bytes = B.idiv(F.length(H.hex_body(t)), 2)
        topic_errs.append(F.when(F.lit(i) < F.col("_nt"), F.coalesce(
            F.concat(F.lit("invalid topic: "), he),
            F.when(n_bytes > 32, F.concat(F.lit("topic length "), n_bytes.cast("string"))))))

    # int24 fields: each word position is checked once; the decimal text of
    # an out-of-range value (for the message) is converted only for such rows.
    positions: dict[tuple, str] = {}
    per_event: dict[str, list] = {}
    for e in EVENTS.values():
        for where, layout in (("topic", e.indexed), ("word", e.data)):
            for i, (_, kind) in enumerate(layout):
                if kind == "int24":
                    key = (where, i + 1 if where == "topic" else i)
                    positions.setdefault(key, f"_tick_{where}{key[1]}")
                    per_event.setdefault(e.name, []).append(positions[key])
    staged = base.select(*base.columns, *[
        (H.topic_word(F.col(f"_t{i}")) if where == "topic" else F.col(f"_w{i}")).alias(col)
        for (where, i), col in positions.items()])
    staged = staged.select(*base.columns, *positions.values(),
                           *[H.word_int24(F.col(c)).alias(f"{c}_v") for c in positions.values()])

    # Outcome from cheap boolean checks only, settled before any conversion:
    # a filter on it reads the finished column, below the conversions, and
    # none of the checks is made again for it.
    tick_bad = _by_name(name, {n: F.greatest(*[F.col(f"{c}_v").isNull() for c in cols])
                               if len(cols) > 1 else F.col(f"{cols[0]}_v").isNull()
                               for n, cols in per_event.items()})
    failed_decode = (~H.is_hex_address(F.col("address")) | F.col("_meta").isNull()
                     | (F.col("_nt") != expected)
                     | F.greatest(*[e.isNotNull() for e in topic_errs])
                     | F.col("_derr").isNotNull()
                     | _unpack_error(name, F.col("_nbytes")).isNotNull()
                     | F.coalesce(tick_bad, F.lit(False)))
    outcome = (F.when(F.col("_perr").isNotNull() | (F.col("_nt") == 0), F.lit(OUTCOME_FAILED))
               .when(name.isNull(), F.lit(OUTCOME_SKIPPED))
               .when(failed_decode, F.lit(OUTCOME_FAILED))
               .otherwise(F.lit(OUTCOME_DECODED)))
    staged = settled(staged.withColumn("outcome", outcome))

    # Integer words -> exact text (signed only where the field is int256).
    # Only words that hold an integer of the row's event are sent.
    wanted = set(fields or S.DECODED.fieldNames())
    integer_events = {i: [e.name for e in EVENTS.values() if i < len(e.data) and e.data[i][0] in wanted
                          and e.data[i][1] not in ("address", "int24")] for i in range(MAX_WORDS)}
    signed_events = {i: [e.name for e in EVENTS.values() if i < len(e.data) and e.data[i][1] == "int256"]
                     for i in range(MAX_WORDS)}
    decoded_row = F.col("outcome") == OUTCOME_DECODED
    words, signs, outs = [], [], []
    for i in (i for i in range(MAX_WORDS) if integer_events[i]):
        ev = signed_events[i]
        words.append(F.when(decoded_row & name.isin(*integer_events[i]), F.lower(F.col(f"_w{i}"))))
        signs.append(name.isin(*ev) if ev else F.lit(False))
        outs.append(f"_n{i}")
    for c in positions.values():
        words.append(F.when(F.col(f"{c}_v").isNull() & F.col("outcome").isNotNull(), F.col(c)))
        signs.append(F.lit(True))
        outs.append(f"{c}_txt")
    staged = staged.withColumn("_texts", words_text(words, signs))
    staged = staged.select(*[c for c in staged.columns if c != "_texts"],
                           *[F.col("_texts")[k].alias(o) for k, o in enumerate(outs)])

    tick_err = _by_name(name, {n: F.coalesce(*[
        F.when(F.col(f"{c}_v").isNull(), F.concat(F.lit("int24 overflow: "), F.col(f"{c}_txt")))
        for c in cols]) for n, cols in per_event.items()})
    decode_err = F.coalesce(
        F.when(~H.is_hex_address(F.col("address")),
               F.concat(F.lit("invalid pool address: "), F.coalesce(F.col("address"), F.lit("")))),
        F.when(F.col("_meta").isNull(),
               F.concat(F.lit("pool meta not found: "), F.lower(F.col("address")))),
        F.when(F.col("_nt") != expected,
               F.concat(F.lit("expected "), expected.cast("string"), F.lit(" topics, got "),
                        F.col("_nt").cast("string"))),
        *topic_errs,
        F.when(F.col("_derr").isNotNull(), F.concat(F.lit("invalid data: "), F.col("_derr"))),
        _unpack_error(name, F.col("_nbytes")),
        tick_err,
    )
    err = (F.when(F.col("_perr").isNotNull(), F.col("_perr"))
           .when(F.col("_nt") == 0, F.lit("missing topic0"))
           .when(F.col("outcome") == OUTCOME_FAILED, decode_err))
    dec = staged.withColumn("error", err)

    # Assemble the decoded struct per event kind.
    tick_value = {k: f"{c}_v" for k, c in positions.items()}
    values = []
    for f in S.DECODED.fieldNames():
        per_ev = {}
        for ev, (where, i, kind) in _field_sources().get(f, {}).items() if f in wanted else ():
            if kind == "address":
                w = H.topic_word(F.col(f"_t{i}")) if where == "topic" else F.col(f"_w{i}")
                v = H.word_address(w)
            elif kind == "int24":
                v = F.col(tick_value[(where, i)])
            else:
                v = F.col(f"_n{i}")
            per_ev[ev] = v
        typ = S.DECODED[f].dataType
        col = _by_name(name, per_ev) if per_ev else None
        values.append((col if col is not None else F.lit(None)).cast(typ).alias(f))
    ok = F.col("outcome") == OUTCOME_DECODED
    out = dec.select(
        "chain_id", "block_number", "block_hash", "tx_hash", "log_index", "address", "timestamp",
        "event_name", "outcome", "error",
        F.coalesce(F.col("_t0"), F.lit("")).alias("topic0"),
        F.when(ok, F.struct(*values)).alias("decoded"),
        F.when(ok, F.col("_meta")).alias("_meta"),
        F.when(ok, F.struct(F.col("_t0").alias("topic0"), F.col("data").alias("data"))).alias("raw"),
    )
    return _attach_live(out, logs, pool_live, bucket_size)


def _attach_live(df: DataFrame, logs: DataFrame, pool_live: DataFrame | None, bucket_size: int) -> DataFrame:
    """pool_meta struct, optionally with live liquidity / slot0 as of the event block."""
    live_null = [F.lit(None).cast("string").alias("liquidity"), F.lit(None).cast(S.SLOT0).alias("slot0")]
    if pool_live is None:
        return df.withColumn("pool_meta", F.when(F.col("_meta").isNotNull(), F.struct(
            *[F.col(f"_meta.{c}") for c in ("token0", "token1", "fee", "tick_spacing")], *live_null))
        ).drop("_meta")
    live = pool_live.select(
        "chain_id", H.address_key(F.col("address")).alias("address"), "block_number",
        F.col("liquidity"), F.struct("sqrt_price_x96", F.col("tick").cast("int").alias("tick")).alias("slot0"))
    # Only decoded rows are looked up: computed once, shuffled once.  The buckets they
    # ask for are taken from the logs themselves, which need no decoding.
    pool = H.address_key(F.col("address")).alias("_pool")
    is_decoded = F.col("outcome") == OUTCOME_DECODED
    d = df.where(is_decoded).select("*", pool)
    asked = logs.select("chain_id", pool, "block_number")
    j = asof_rows(d, live, ["chain_id", "_pool"], ["chain_id", "address"], "block_number", "block_number",
                  ["liquidity", "slot0"], "_lv_", asked, bucket_size=bucket_size, with_latest=True)
    latest = F.col("block_number") == 0
    liq = F.when(latest, F.col("_lv_latest_liquidity")).otherwise(F.col("_lv_liquidity"))
    slot0 = F.when(latest, F.col("_lv_latest_slot0")).otherwise(F.col("_lv_slot0"))
    meta = F.when(F.col("_meta").isNotNull(), F.struct(
        *[F.col(f"_meta.{c}") for c in ("token0", "token1", "fee", "tick_spacing")],
        F.when(liq != "", liq).alias("liquidity"), slot0.alias("slot0")))
    cols = [c for c in df.columns if c != "_meta"]
    looked_up = j.select(*cols, meta.alias("pool_meta"))
    rest = df.where(~is_decoded).select(*cols, F.lit(None).cast(looked_up.schema["pool_meta"].dataType).alias("pool_meta"))
    return looked_up.unionByName(rest)


def typed_events(decoded: DataFrame) -> DataFrame:
    """Rows that decoded, in the TYPED_EVENT layout."""
    return decoded.where(F.col("outcome") == OUTCOME_DECODED).select(*S.TYPED_EVENT.fieldNames())


def decode_errors(decoded: DataFrame) -> DataFrame:
    """Dead-letter rows (P10): log keys, topic0, message.  A line that was not
    JSON carries only its message (other fields zero / empty)."""
    f = decoded.where(F.col("outcome") == OUTCOME_FAILED)
    return f.select(
        F.coalesce("chain_id", F.lit(0)).cast("bigint").alias("chain_id"),
        F.coalesce("block_number", F.lit(0)).cast("bigint").alias("block_number"),
        F.coalesce("tx_hash", F.lit("")).alias("tx_hash"),
        F.coalesce("log_index", F.lit(0)).cast("bigint").alias("log_index"),
        F.coalesce("address", F.lit("")).alias("address"),
        "topic0", "error")


def decode_counters(decoded: DataFrame) -> DataFrame:
    """total / decoded / skipped / failed as (counter, value) rows (P14), in one pass."""
    c = decoded.groupBy("outcome").agg(F.count(F.lit(1)).alias("value"))
    # Grouping sets over at most three rows: each outcome, and all of them.
    total = c.rollup("outcome").agg(F.sum("value").alias("value"))
    return total.select(F.coalesce("outcome", F.lit("total")).alias("counter"), F.coalesce("value", F.lit(0)).alias("value"))


# ---------------------------------------------------------------------------
# Event layouts as a table (P6, F1-F4): a further kind of event is a further row.

SPEC_SCHEMA = ("topic0 string, event_name string, indexed array<struct<name:string,kind:string>>, "
               "data array<struct<name:string,kind:string>>")


def spec_table(spark, specs=tuple(EVENTS.values())) -> DataFrame:
    """The layouts of ``specs`` as rows of a known, small size, so that they can be broadcast."""
    rows = [dict(topic0=e.topic0.lower(), event_name=e.name, **{
        side: [dict(name=n, kind=k) for n, k in fields] for side, fields in (("indexed", e.indexed), ("data", e.data))}) for e in specs]
    table = T._parse_datatype_string(SPEC_SCHEMA)
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), T.ArrayType(table))))


def decode_by_spec(logs: DataFrame, specs: DataFrame) -> DataFrame:
    """Decode logs by the layouts in ``specs`` (SPEC_SCHEMA), whatever events they name.

    Returns the log key, address, event_name, outcome, error and ``fields``, a
    map of field name to text (addresses lower case, integers in decimal).  One
    expression serves all layouts: the words of a log are an array, topics first,
    and each is read by the kind at its place.  Layouts are broadcast if
    small (size-checked); of several with one topic0 the first by name counts.
    Errors are those of ``decode_logs`` for topics, data and ranges.
    """
    one = first_copy(specs.select(F.lower("topic0").alias("_s0"), "event_name", "indexed", "data"), ["_s0"], [
        F.col("event_name"), F.to_json(F.struct("indexed", "data"))])
    s = bounded_broadcast(one.withColumnsRenamed({"indexed": "_ix", "data": "_dt"}))
    topics = F.coalesce(F.col("topics"), F.array().cast("array<string>"))
    data = F.coalesce(F.col("data"), F.lit(""))
    rows = logs.select("chain_id", "block_number", "tx_hash", "log_index", "address", topics.alias("_topics"), data.alias("_data"))
    j = rows.join(s, F.lower(F.get("_topics", 0)) == F.col("_s0"), "left").withColumn("_body", F.lower(H.hex_body(F.col("_data"))))
    n_bytes, need = B.idiv(F.length("_body"), 2), F.size("_ix") + 1
    topic_error = F.get(F.filter(F.transform(F.slice("_topics", 2, F.size("_topics")), lambda t: F.coalesce(
        F.concat(F.lit("invalid topic: "), H.hex_error(t)),
        F.when(F.length(t) > 66, F.concat(F.lit("topic length "), B.idiv(F.length(t) - 2, 2).cast("string"))))),
        lambda e: e.isNotNull()), 0)
    words = F.concat(F.transform("_ix", lambda f, i: H.topic_word(F.get("_topics", i + 1))),
                     F.transform("_dt", lambda f, i: F.substr("_body", i * H.WORD + 1, F.lit(H.WORD))))
    staged = j.select("*", F.concat("_ix", "_dt").alias("_kinds"), words.alias("_words"), F.coalesce(
        F.when(F.size("_topics") != need, F.concat(F.lit("expected "), need.cast("string"), F.lit(" topics, got "),
                                                   F.size("_topics").cast("string"))),
        topic_error, F.concat(F.lit("invalid data: "), H.hex_error(F.col("_data"))),
        F.when((n_bytes == 0) & (F.size("_dt") > 0), F.concat(F.lit("unpack "), F.col("event_name"), F.lit(
            ": abi: attempting to unmarshall an empty string while arguments are expected"))),
        F.when(B.idiv(n_bytes, 32) < F.size("_dt"), F.concat(
            F.lit("unpack "), F.col("event_name"), F.lit(": abi: cannot marshal in to go type: length insufficient "),
            n_bytes.cast("string"), F.lit(" require "), ((B.idiv(n_bytes, 32) + 1) * 32).cast("string")))).alias("_error"))
    # int24 words beyond their range fail the log; their text is only made for the message.
    ticks = F.transform("_words", lambda w, i: F.when(F.get("_kinds", i)["kind"] == "int24", H.word_int24(w)))
    staged = staged.withColumn("_ticks", ticks).withColumn("_wide", F.get(F.filter(F.transform("_words", lambda w, i: F.when(
        (F.get("_kinds", i)["kind"] == "int24") & F.get("_ticks", i).isNull(), w)), lambda w: w.isNotNull()), 0))
    # The outcome is settled before any conversion, so only the rows a caller keeps are converted.
    failed = (F.size("_topics") == 0) | (F.col("_s0").isNotNull() & (F.col("_error").isNotNull() | F.col("_wide").isNotNull()))
    outcome = F.when(failed, OUTCOME_FAILED).when(F.col("_s0").isNull(), OUTCOME_SKIPPED).otherwise(OUTCOME_DECODED)
    staged = settled(staged.select("chain_id", "block_number", "tx_hash", "log_index", "address", "event_name", "_s0", "_kinds", "_words",
                                   "_ticks", "_wide", "_error", (F.size("_topics") == 0).alias("_bare"), outcome.alias("outcome")))
    read = F.col("_s0").isNotNull() & F.col("_error").isNull()
    integers = F.transform("_words", lambda w, i: F.when(~F.get("_kinds", i)["kind"].isin("address", "int24"), w))
    flags = F.transform("_kinds", lambda k: k["kind"] == "int256")
    texts = word_array_text(F.when(read, F.concat(integers, F.array("_wide"))), F.when(read, F.concat(flags, F.array(F.lit(True)))))
    staged = staged.withColumn("_texts", texts)
    value = F.transform("_words", lambda w, i: F.when(F.get("_kinds", i)["kind"] == "address", H.word_address(w))
                        .when(F.get("_kinds", i)["kind"] == "int24", F.get("_ticks", i).cast("string")).otherwise(F.get("_texts", i)))
    error = F.when(F.col("_bare"), F.lit("missing topic0")).when(F.col("_s0").isNotNull(), F.coalesce(
        F.col("_error"), F.when(F.col("_wide").isNotNull(), F.concat(F.lit("int24 overflow: "), F.element_at("_texts", -1)))))
    fields = F.map_from_arrays(F.transform("_kinds", lambda k: k["name"]), value)
    return staged.select("chain_id", "block_number", "tx_hash", "log_index", "address", "event_name", "outcome", error.alias("error"),
                         F.when(F.col("outcome") == OUTCOME_DECODED, fields).alias("fields"))
