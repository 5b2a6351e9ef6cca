import hashlib
import itertools
import random
import re
import zlib

import pytest

from copse.llm import repair as R
from copse.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen
                   else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def edits(rows, found):
    """All edit sequences with up to two inserts in each gap: (cost, audit, lines)."""
    gaps = [[(2 * n, "I" * n, [(r, "") for r in roles]) for n in range(3)
             for roles in itertools.product(("user", "assistant"), repeat=n)]][0]
    per_row = []
    for (_, role, text), fault in zip(rows, found):
        cut = fault == "truncated"
        choice = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            choice += [(cut, "K", [(role, text)])] + [(2 + cut, "R", [(r, text)]) for r in ("user", "assistant")]
        per_row.append(choice)
    layers = [gaps] + [x for c in per_row for x in (c, gaps)]
    for way in itertools.product(*layers):
        yield sum(w[0] for w in way), "".join(w[1] for w in way), [line for w in way for line in w[2]]


def brute(rows):
    """rows: (turn, role, text) of one conversation, in order, no nulls but in turn."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()
    found = faults(rows)
    cost, audit, lines = min((c, a, x) for c, a, x in edits(rows, found)
                             if LEGAL.fullmatch("".join((r[:1] or "-") for r, _ in x)))
    at = [t for t, _, _ in rows if t is not None]
    gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


TEXTS = ["Fine.", "Cut off", "", " \t\n", "Yes!", "Why?  ", None, "é.", "x "]
ROLES = ["user", "user", "assistant", "assistant", "system", "tool", "", None]


def some(n, longest, seed):
    rng = random.Random(seed)
    return [(c, rng.choice([None, *range(6)]), rng.choice(ROLES), rng.choice(TEXTS))
            for c in [None, *range(n)] for _ in range(rng.randint(1, longest))]


def test_equals_all_edit_sequences(spark):
    rows = some(100, 3, 1)
    out = got(R.repair(spark.createDataFrame(rows, SCHEMA)))
    want = {c: brute(r) for c, r in by_conversation(rows).items()}
    assert out == want


def plain(rows, found):
    """The least (cost, audit) by state, as tuples."""
    def inserts(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                for s in "ua":
                    to = R.MOVE.get((q, s))
                    if to is not None:
                        best[to] = min(best.get(to, (9e9, "")), (c + 2, a + "I"))
        return best

    best = {R.START: (0, "")}
    for (_, role, _), fault in zip(rows, found):
        new = {}
        for q, (c, a) in inserts(best).items():
            ways = [(q, 3, "D")]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                ways += [(R.MOVE.get((q, role[:1])), extra, "K")] + [(R.MOVE.get((q, s)), 2 + extra, "R") for s in "ua"]
            for to, k, letter in ways:
                if to is not None:
                    new[to] = min(new.get(to, (9e9, "")), (c + k, a + letter))
        best = new
    best = inserts(best)
    return min(best[q] for q in (R.START, R.ASSISTANT) if q in best)


@pytest.mark.parametrize("width", [16, 40, 128])
@pytest.mark.parametrize("roles", [["user"], ["user", "assistant"], ["system", "user", "assistant", "tool"]])
def test_long_conversations_and_any_width(width, roles):
    rng = random.Random(width)
    rows = [(i, rng.choice(roles), f"t{i}" + rng.choice([".", ""])) for i in range(700)]
    fix = R.Repair(width)
    found = faults(rows)
    for (_, role, text), fault in zip(rows, found):
        fix.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
    assert fix.finish()[:2] == plain(rows, found)


@pytest.mark.parametrize("roles", ["ua", "u", "a", "s", "su", "t", "uuaa", "saua", "uat"])
@pytest.mark.parametrize("blank", [False, True])
def test_integers_stay_short(roles, blank):
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    fix = R.Repair(32)
    for i in range(4000):
        fix.row(names[roles[i % len(roles)]], f"t{i}.", blank and i > 5, False)
    assert fix.width <= 128
    audit = fix.finish()[1]
    assert len(audit.replace("I", "")) == 4000


def test_repaired_rows_give_the_hash(spark):
    rows = spark.createDataFrame(some(60, 8, 5), SCHEMA)
    fixed = R.repair(rows)
    lines = {}
    for r in R.turns(rows, fixed).collect():
        lines.setdefault(r.conv_id, []).append((r.position, f"{r.role}:{r.text}"))
    for r in fixed.collect():
        text = "\n".join(x for _, x in sorted(lines.get(r.conv_id, [])))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def damaged(rows):
    out, all_ids = [], {}
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        all_ids[c] = None
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out, all_ids


def test_the_query_with_damage(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS)) for c in [None, *range(60)] for t in (None, 0, 1)] + [(400, 1, "user", "a.")] * 3
    d = spark.createDataFrame([(*r, 1, True) for r in rows], SCHEMA + ", kind int, gone boolean")
    d.write.parquet(f"{tmp_path}/conversations.parquet")
    out = got(QUERIES["op13_repair_conversations"](spark, str(tmp_path)))
    left, ids = damaged(rows)
    groups = by_conversation(left)
    assert out == {c: brute(groups.get(c, [])) for c in ids}


def test_the_oracle(spark):
    import duckdb
    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/sf0.01/conversations.parquet')")
    rel = con.sql(ORACLES["op13_repair_conversations"])
    want = {tuple(r) for r in rel.fetchall()}
    df = QUERIES["op13_repair_conversations"](spark, "/root/testdata/sf0.01").select(*rel.columns)
    assert {tuple(r) for r in df.collect()} == want


def test_empty_table(spark):
    assert R.repair(spark.createDataFrame([], SCHEMA)).count() == 0
