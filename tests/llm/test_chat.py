import hashlib

import duckdb

from tidepool.llm import chat as C


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


ROWS = [
    (1, 1, "user", "hi"), (1, 0, "system", None), (1, 2, "user", "again"), (1, 3, "assistant", "a\n"),
    (1, 4, "assistant", "<|im_end|>\\<|x"), (2, None, "user", ""), (2, 0, None, "\\\\ <\\| <<|"), (2, 0, None, "\\\\ <\\| <<|"),
    (3, 0, "assis\ntant\\n<|nl|>", "<|im_sep|>"), (None, 0, "assistant", "é😀"), (None, 1, "assistant", "x" * 70_000),
    (4, 5, "user", "b"), (4, 5, "user", "a"), (4, 5, "assistant", "z"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, formatted string, n_turns int")


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for k, t, r, x in rows if k == c))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def test_round_trip(spark):
    formatted = C.format_conversations(frame(spark))
    assert formatted.columns == ["conv_id", "formatted"]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(formatted).collect()}
    assert got == expected(ROWS)


def test_neighbours_of_one_role_are_merged(spark):
    text = {r.conv_id: r.formatted for r in C.format_conversations(frame(spark)).collect()}
    assert text[4] == ("<|im_start|>assistant\nz<|im_end|>\n<|im_start|>user\na<|im_sep|>b<|im_end|>\n")
    assert text[1].count(C.START) == 3 and text[1].count(C.SEP) == 2 and text[1].count(C.END) == 3
    assert text[3].count("\n") == 2


def test_empty_table(spark):
    assert C.digests(C.format_conversations(frame(spark).limit(0))).count() == 0


def test_query_equals_sql(spark, sf):
    got = sorted(tuple(r) for r in C.op3_chat_formatting(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert got == sorted(con.execute(C.OP3_SQL).fetchall())
    probe = next(r for r in got if r[0] == -1)
    assert probe[1:3] == (2, sha("".join(f"{r}\n{C.PROBE_TEXT}\n" for r in ("user", "assistant"))))
    assert probe[3:5] == (len(C.PROBE_TEXT), sha(C.PROBE_TEXT))
