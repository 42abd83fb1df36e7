import hashlib
import zlib
from itertools import product

import duckdb
import pytest

from tidepool.llm import structure_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, audit string, d int, copies string"


def frame(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA)
    return df.repartition(parts)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(x for x in text if x not in ".!?")
        if fate == 4:
            role = "user"
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(R.SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def legal(roles):
    body = roles[1:] if roles[:1] == ["s"] else roles
    return not roles or (len(body) >= 2 and len(body) % 2 == 0 and all(x == "ua"[i % 2] for i, x in enumerate(body)))


def cheapest(rows):
    """All edit scripts with at most three inserted rows in one place, by plain enumeration with pruning by cost."""
    fault = faults(rows)
    best = None
    slots = ["", "u", "a", "ua", "au", "uau", "aua"]

    def walk(i, cost, audit, roles, texts):
        nonlocal best
        if best is not None and (cost, audit) > best[:2] and cost > best[0]:
            return
        for s in slots:
            c, a = cost + 3 * len(s), audit + "I" * len(s)
            rs, ts = roles + list(s), texts + [("user:" if x == "u" else "assistant:") for x in s]
            if i == len(rows):
                if legal(rs) and (best is None or (c, a) < best[:2]):
                    best = (c, a, "\n".join(ts))
                continue
            _, _, role, text = rows[i]
            walk(i + 1, c + 4, a + "D", rs, ts)
            if fault[i] not in ("blank", "duplicate"):
                late = 3 if fault[i] == "truncated" else 0
                walk(i + 1, c + late, a + "K", rs + [role[:1] or "-"], ts + [f"{role}:{text}"])
                for x, name in (("u", "user"), ("a", "assistant")):
                    walk(i + 1, c + 3 + late, a + "R", rs + [x], ts + [f"{name}:{text}"])
    # A bound to prune by: everything deleted.
    best = (4 * len(rows), "D" * len(rows), "")
    walk(0, 0, "", [], [])
    return best


def expected(rows, all_ids):
    out = {}
    for c in all_ids:
        own = ordered([r for r in rows if r[0] == c])
        fault = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit, text = cheapest(own)
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, fault.count("blank"), fault.count("duplicate"),
                  fault.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                  hashlib.sha256(text.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes!"), (1, 4, "user", "open"),
    (2, 0, "assistant", "Hello."), (2, 1, "assistant", "Hello."), (2, 2, "user", "\t\x0b "), (2, None, "tool", "x?"),
    (3, None, None, None), (3, 1, "", "a. \n"), (4, 0, "user", "a!"), (4, 0, "user", "a!"), (4, 0, "user", "b!"), (4, 0, "assistant", "c!"),
    (None, 0, "user", "é."), (None, 1, "admin", " "), (None, 9, "user", "end"), (5, 3, "system", "only."),
    (6, 1, "user", "q?"), (6, 2, "system", "s."), (6, 3, "assistant", "r."), (6, 3, "assistant", "x" * 50_000 + "."),
]


def report(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("limit", [1, 2, 2048])
def test_against_enumeration(spark, limit):
    df = frame(spark, ROWS)
    got = report(R.report(R.named_rows(df), limit))
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ROWS]
    assert got == expected(rows, {r[0] for r in ROWS})


def test_damage_and_conversations_that_lose_all_rows(spark):
    gone = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = ROWS + [(gone, 0, "user", "x.")] + [(c, t, "ua"[t % 2] == "u" and "user" or "assistant", f"{t}.") for c in range(50, 60) for t in range(4)]
    got = report(R.report(R.damage(frame(spark, rows))))
    assert got == expected(damaged(rows), {r[0] for r in rows})
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_conversation_with_most_rows_is_cut_into_segments(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"t{t}." if t % 5 else "same.") for t in range(400)] + [(8, 0, "user", "a.")] * 300
    whole = report(R.report(R.named_rows(frame(spark, rows, 6))))
    cut = report(R.report(R.named_rows(frame(spark, rows, 6)), 7))
    assert whole == cut and whole[8][:3] == (0, 0, 299) and whole[8][6] == "K" + "D" * 299 + "I"
    parts = R.segments(R.slim_rows(R.named_rows(frame(spark, rows, 6))), 7).collect()
    assert max(len(p.seq) for p in parts) <= 7 and len({p.part for p in parts if p.conv_id == 7}) > 1


def test_repaired_rows(spark):
    out = R.repair(R.named_rows(frame(spark, ROWS)))
    assert out.columns == ["conv_id", "position", "edit", "role", "text"]
    by = {}
    for r in sorted(out.collect(), key=lambda r: r.position):
        by.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    got = report(R.report(R.named_rows(frame(spark, ROWS))))
    for c, row in got.items():
        assert hashlib.sha256("\n".join(by.get(c, [])).encode()).hexdigest() == row[-1]


def test_matrices_do_not_depend_on_the_grammar():
    words = ["".join(w) for n in (1, 2, 3) for w in product("suoUX", repeat=n)]
    rules = [("Ā", "su"), ("ā", "ĀU"), ("Ă", "XX"), ("ă", "uX"), ("Ą", "oo")]
    plain, packed = R.Solver([]), R.Solver(rules)
    for w in words:
        assert plain.whole(w) == packed.whole(w)
        assert R.finish(R.step(R.BEGIN, packed.block(w))) == plain.whole(w)


def test_grammar_counts_weighted_pairs_over_all_sequences(spark):
    seqs = spark.createDataFrame([("uaua", 100), ("sua", 10), ("oX", 1)], "seq string, n long")
    rules = R.draw_grammar(seqs, rounds=2, per_round=1)
    assert rules == [("Ā", "ua"), ("ā", "ĀĀ")]
    assert R.rewrite("suaua", rules) == "sā"


def test_empty_table(spark):
    assert R.report(R.damage(frame(spark, ROWS).limit(0))).count() == 0
    assert R.repair(R.named_rows(frame(spark, ROWS).limit(0))).count() == 0


def test_query_equals_sql(spark, sf):
    got = sorted(tuple(r) for r in R.op11_structure_repair(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert got == sorted(con.execute(R.OP11_SQL).fetchall())
