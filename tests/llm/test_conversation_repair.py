import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakehold.llm import conversation_repair as cr

SPACES = " \t\n\x0b\x0c\r"
NEXT = {"s": {}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            out.append((conv, turn, role, "", True))
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out.extend([(conv, turn, "user" if kind == 4 else role, text, False)] * (2 if kind == 3 else 1))
    return out


def brute_repair(rows):
    """Damaged rows of one conversation -> expected result, by a forward search over (row, state)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x, dropped in rows if not dropped]
    digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}\0{r[2]}"[:64], digest(r[1], r[2])))
    faults, seen = [], set()
    for _, r, x in rows:
        bare = x.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((r, x))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    # states by the last initial; best = (cost, audit, lines)
    best = {"": (0, "", ())}

    def offer(into, state, cost, audit, lines):
        if state not in into or (cost, audit) < into[state][:2]:
            into[state] = (cost, audit, lines)

    def with_inserts(best):
        for _ in range(4):
            for state, (c, a, lines) in list(best.items()):
                to = "a" if state == "u" else "u"
                offer(best, to, c + 2, a + "I", (*lines, ("assistant:" if to == "a" else "user:")))
        return best

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (c, a, lines) in with_inserts(dict(best)).items():
            offer(new, state, c + 3, a + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            i = role[:1]
            if i == "s" and state == "":
                offer(new, "s", c + more, a + "K", (*lines, f"{role}:{text}"))
            elif i in "ua" and i and (state == "u") == (i == "a"):
                offer(new, i, c + more, a + "K", (*lines, f"{role}:{text}"))
            to = "a" if state == "u" else "u"
            offer(new, to, c + 2 + more, a + "R", (*lines, f"{'assistant' if to == 'a' else 'user'}:{text}"))
        best = new
    best = with_inserts(best)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(damaged_rows):
    convs = {}
    for r in damaged_rows:
        convs.setdefault(r[0], []).append(r)
    return sorted(((c, *brute_repair(rs)) for c, rs in convs.items()), key=str)


ROLES = ["system", "user", "assistant", "tool", "", None, "s", "user"]
TEXTS = ["Hello.", "What now?", "no end", "", " \n", None, "Yes! ", "a.b", "é 漢字 😀!", "." * 40 + " x"]


def random_rows(seed, n_convs=40, most=14):
    rnd = random.Random(seed)
    rows = []
    for c in range(n_convs):
        conv = None if c == 3 else c
        for t in range(rnd.randint(1, most)):
            turn = None if rnd.random() < 0.05 else t if rnd.random() < 0.9 else rnd.randint(-3, 30)
            role = rnd.choice(["user", "assistant"][t % 2:][:1] * 6 + ROLES)
            rows.append((conv, turn, role, rnd.choice(TEXTS) if rnd.random() < 0.3 else f"text {rnd.random()}{rnd.choice('.!? ,')}"))
    return rows + rows[5:9]  # repeated rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "conv_id long, turn long, role string, text string, sid string, codes string, row int")


def run(spark, rows, **kw):
    df = cr.damaged(frame(spark, rows))
    assert sorted(map(str, map(tuple, df.where("not dropped").collect()))) == sorted(str(r) for r in brute_damage(rows) if not r[4])
    return sorted(map(tuple, cr.summary(cr.repaired(df, **kw)).collect()), key=str)


@pytest.mark.parametrize(("chunk_rows", "chunk_bytes", "max_fixups"), [(10_000, 1 << 20, 4), (3, 1 << 20, 4), (2, 1 << 20, 0), (1, 1 << 20, 1), (50, 30, 8)])
def test_equals_brute_force(spark, chunk_rows, chunk_bytes, max_fixups):
    rows = random_rows(chunk_rows + max_fixups)
    assert run(spark, rows, chunk_rows=chunk_rows, chunk_bytes=chunk_bytes, max_fixups=max_fixups) == brute(brute_damage(rows))


def undamaged(spark, rows):
    return frame(spark, rows).select("conv_id", "turn", "role", "text", F.lit(False).alias("dropped"))


@pytest.mark.parametrize("max_fixups", [0, 2, 50])
def test_long_conversations_of_many_chunks(spark, max_fixups):
    rnd = random.Random(8)
    rows = [(1, k, ["user", "assistant"][k % 2], f"turn {k}.") for k in range(200)]
    rows += [(2, k, "tool", f"odd {k}.") for k in range(101)]  # nothing to keep: ranks do not converge
    rows += [(3, None, "user", "again and again.") for _ in range(150)]  # all but one are deleted
    rows += [(4, k, rnd.choice(["user", "assistant", "system", "x"]), f"mixed {k}{rnd.choice('.,')}") for k in range(150)]
    rows += [(5, 0, "user", "hi."), (5, 1, "assistant", "hi.")]
    got = sorted(map(tuple, cr.summary(cr.repaired(undamaged(spark, rows), chunk_rows=7, max_fixups=max_fixups)).collect()), key=str)
    assert got == brute([(*r, False) for r in rows])


def test_fix_ups_settle_regular_conversations_in_two_passes(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], f"turn {k}.") for k in range(400)]
    open_ = cr.chunks(undamaged(spark, rows), chunk_rows=10).where("is_open")
    v, passes = cr._settled(cr._with_duplicates(open_, "bigint"), "bigint", 10)
    assert open_.count() >= 30 and passes <= 3
    # all vectors are those of one backward run over the whole conversation, up to a constant
    steps = cr.Steps()
    parts = v.orderBy("sid").collect()
    whole = cr.backward(steps, b"".join(bytes(p.codes) for p in parts), cr.END)
    at = 0
    for p in parts:
        assert tuple(p.start_vec) == whole[at]
        at += len(p.codes)
        assert tuple(p.end_vec) == whole[at]


def test_rerun_stops_where_ranks_have_converged():
    class Counted(cr.Steps):
        calls = 0

        def before(self, after, code):
            self.calls += 1
            return super().before(after, code)

    codes = bytes([cr.USER * 4, cr.ASSISTANT * 4] * 500)
    steps = Counted()
    old = cr.backward(steps, codes, cr.SPECULATIVE)[0]
    steps.calls = 0
    assert cr.rerun(steps, codes, cr.END, cr.SPECULATIVE, old) == cr.backward(cr.Steps(), codes, cr.END)[0]
    assert steps.calls < 20


def test_matrix_equals_backward():
    rnd = random.Random(2)
    steps = cr.Steps()
    for _ in range(200):
        codes = bytes(rnd.randrange(16) for _ in range(rnd.randint(0, 30)))
        assert cr.applied(cr.matrix(steps, codes), cr.END) == cr.backward(steps, codes, cr.END)[0]


def test_empty_and_vanished_conversations(spark):
    assert run(spark, random_rows(1)[:0]) == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    for chunk_rows in (1, 100):
        assert run(spark, [(gone, 0, "user", "Hi.")], chunk_rows=chunk_rows) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_text_and_chunk_bounds(spark):
    long = "word " * 400_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "user", "x" * 10), (2, 0, "user", long), (2, 1, "assistant", "ok.")]
    df = undamaged(spark, rows)
    got = sorted(map(tuple, cr.summary(cr.repaired(df, chunk_bytes=1000)).collect()), key=str)
    assert got == brute([(*r, False) for r in rows])
    assert cr.chunks(df, chunk_rows=2).agg(F.max(F.size("lines"))).first()[0] <= 2
