"""Conversation structure repair: rank-convergence parallel Viterbi over chunks of turns.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?`` and no row is blank or repeats an earlier
one. A repair is a string of edits in the order of the rows: Keep (0), Rerole to user or assistant (2), Delete (3,
required for blank and duplicate rows), Insert an empty user or assistant text (2); a truncated row that stays
costs 1 more. Of the cheapest repairs the one whose string of initials is least in ASCII is made.

The dynamic program has four states (nothing yet, after s, after u, after a) and runs backwards: a vector holds the
cost from each state to the end. Rows are dealt by range over (conversation, turn, rest of the order), sorted and
cut into chunks of bounded rows and bytes, so a conversation of any length is spread over tasks and no task holds
more than a chunk of it. A conversation inside one chunk is repaired at once. The others:

1. all chunks run backwards together, the last of a conversation from the true end, others from a speculative
   vector;
2. fix-up passes: a chunk whose successor now begins with another vector runs again from it, until the vectors
   differ only by a constant from those of its run before, as from there on nothing can change; passes go on until
   no chunk changes (a few: ranks converge within some rows). Chunks that ``max_fixups`` passes leave open (long
   stretches without any role to keep) are settled exactly from their transfer matrices, one light row a chunk;
3. the backward costs of all chunks, now stitched, drive the forward trace: each chunk is traced from all four
   states, the states at the chunks' borders follow from these, and the trace from the true state gives edits.

Per conversation, one streaming pass over its chunks in order puts counts, edits and texts together. The string of
edits and the digest of all lines are single values of a whole conversation by definition; they are built as the
chunks stream by.

Defined results: a null role or text reads as one space; a null conversation id or turn stays null and forms one
conversation, or comes first in it. Rows of equal turn are ordered by role and text (by the first 64 characters of
both, then by digest), and truly equal rows are interchangeable. A row with ``dropped`` counts for nothing but
keeps its conversation, so a conversation without any row left has zeros and no edits. Roles with another initial
than s, u or a are never kept as they are. Empty tables give no rows; only the four columns are read, so others may
have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lakehold.llm.common import stored
from lakehold.session import shared_dir

CHUNK_ROWS, CHUNK_BYTES = 16_384, 4 << 20  # of a conversation that one task holds
MAX_FIXUPS = 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults
SYSTEM, USER, ASSISTANT, OTHER = range(4)  # initials
START, AFTER_S, AFTER_U, AFTER_A = range(4)  # states
NEVER = 1 << 40
SPECULATIVE = (0, 0, 0, 0)
END = (0, 4, 2, 0)  # cost to end in each state, with inserts
_SPACES = " \t\n\x0b\x0c\r"
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
LINES = "array<struct<role:string,text:string>>"


# ---------------------------------------------------------------- the program over rows


def _insert(state: int) -> int:
    return AFTER_A if state == AFTER_U else AFTER_U


def _kept(state: int, initial: int) -> int | None:
    if initial == SYSTEM:
        return AFTER_S if state == START else None
    if initial == USER:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == ASSISTANT and state == AFTER_U else None


def _options(state: int, code: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row, in ASCII order of the edits; inserts aside."""
    initial, fault = divmod(code, 4)
    out = [(DELETE, 3, state)]
    if fault not in (BLANK, DUPLICATE):
        more = fault == TRUNCATED
        after = _kept(state, initial)
        if after is not None:
            out.append((KEEP, int(more), after))
        out.append((REROLE, 2 + more, _insert(state)))  # the one role that may come next
    return out


def _before(after: tuple, code: int) -> list[int]:
    """Cost vector before a row from the one after it."""
    b = [min(c + after[t] for _, c, t in _options(s, code)) for s in range(4)]
    b[AFTER_U], b[AFTER_A] = min(b[AFTER_U], 2 + b[AFTER_A]), min(b[AFTER_A], 2 + b[AFTER_U])
    return [min(b[START], 2 + b[AFTER_U]), min(b[AFTER_S], 2 + b[AFTER_U]), b[AFTER_U], b[AFTER_A]]


class Steps:
    """The steps met so far; normalised vectors are few, so nearly all steps are looked up."""

    def __init__(self):
        self.back: dict = {}
        self.forth: dict = {}

    def before(self, after: tuple, code: int) -> tuple[tuple, int]:
        """(vector before a row less its least entry, that entry)."""
        got = self.back.get((after, code))
        if got is None:
            b = _before(after, code)
            low = min(b)
            got = self.back[after, code] = (tuple(min(x - low, NEVER) for x in b), low)
        return got

    def edits(self, state: int, code: int, after: tuple) -> tuple[str, int, int]:
        """(edits up to and with a row, their cost, next state): least in ASCII among the cheapest."""
        got = self.forth.get((state, code, after))
        if got is None:
            here, out, cost, s = _before(after, code), "", 0, state
            while True:
                best = {e: (c, t) for e, c, t in _options(s, code) if c + after[t] == here[s]}
                if DELETE not in best and 2 + here[_insert(s)] == here[s]:
                    out, cost, s = out + INSERT, cost + 2, _insert(s)
                    continue
                edit = min(best)
                got = self.forth[state, code, after] = (out + edit, cost + best[edit][0], best[edit][1])
                break
        return got


def backward(steps: Steps, codes: bytes, end: tuple) -> list[tuple]:
    """Normalised vectors before row 0, 1, ... and after the last one."""
    out = [end]
    for code in reversed(codes):
        out.append(steps.before(out[-1], code)[0])
    return out[::-1]


def rerun(steps: Steps, codes: bytes, end: tuple, old_end: tuple, old_start: tuple) -> tuple:
    """Vector at the chunk's begin from another end. From the row on at which the vectors of this run and of the
    one before differ only by a constant, the old run holds."""
    new, old = end, old_end
    for code in reversed(codes):
        if new == old:
            return old_start
        new, old = steps.before(new, code)[0], steps.before(old, code)[0]
    return new


def matrix(steps: Steps, codes: bytes) -> list[int]:
    """Cost from each state before the rows to each one after them, row by row."""
    cols = []
    for k in range(4):
        v, total = tuple(0 if s == k else NEVER for s in range(4)), 0
        for code in reversed(codes):
            v, low = steps.before(v, code)
            total += low
        cols.append([min(x + total, NEVER) if x < NEVER else NEVER for x in v])
    return [cols[e][s] for s in range(4) for e in range(4)]


def applied(m: list[int], end: tuple) -> tuple:
    """Normalised vector before a chunk, from its matrix and the vector after it."""
    b = [min(m[4 * s + e] + end[e] for e in range(4)) for s in range(4)]
    low = min(b)
    return tuple(min(x - low, NEVER) for x in b)


def trace(steps: Steps, codes: bytes, vectors: list[tuple], state: int, last: bool) -> tuple[str, int, int]:
    """(edits, their cost, state after them)."""
    out, cost = [], 0
    for code, after in zip(codes, vectors[1:], strict=True):
        e, c, state = steps.edits(state, code, after)
        out.append(e)
        cost += c
    while last and state in (AFTER_S, AFTER_U):
        out.append(INSERT)
        cost, state = cost + 2, _insert(state)
    return "".join(out), cost, state


def apply_edits(roles: list[str], texts: list[str], edits: str, state: int) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits, from a state."""
    out_roles, out_texts, k = [], [], 0
    for e in edits:
        if e == DELETE:
            k += 1
            continue
        state = _kept(state, initial_code(roles[k][:1])) if e == KEEP else _insert(state)
        out_roles.append(roles[k] if e == KEEP else ROLE_OF[USER if state == AFTER_U else ASSISTANT])
        out_texts.append("" if e == INSERT else texts[k])
        k += e != INSERT
    return out_roles, out_texts


def initial_code(initial: str) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial, OTHER)


# ---------------------------------------------------------------- chunks


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, dropped``: rows damaged by the remainder of a checksum of id and turn."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col)).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(shown(text_col), ".!?", "")).otherwise(shown(text_col))
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(shown(role_col)).alias("role"),
        text.alias("text"), (kind == 0).alias("dropped"), F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", "dropped", F.explode("times").alias("copy")).drop("copy")


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with their code (no duplicates yet) and digest, in order within range partitions."""
    text_is = F.coalesce(F.col("text"), F.lit(" "))
    role_is = F.coalesce(F.col("role"), F.lit(" "))
    bare = F.rtrim(text_is, F.lit(_SPACES))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    first = F.substring(role_is, 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    digest = F.unhex(F.sha2(F.concat(F.length(role_is).cast("string"), F.lit(":"), role_is, text_is), 256))
    d = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role_is.alias("role"), text_is.alias("text"),
                    (initial * 4 + fault).cast("int").alias("code"), digest.alias("digest"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    order = ["conv_id", "turn", "begin", "digest", "row"]
    d = d.select("*", F.left(F.concat("role", F.lit("\x00"), "text"), F.lit(64)).alias("begin"), F.monotonically_increasing_id().alias("row"))
    return d.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "code", "digest", "dropped")


_META = ("is_open boolean, min_turn long, max_turn long, turns long, blank long, duplicate long, truncated long, illegal long, "
         "first_initial string, last_initial string, cost long, audit string")


def _chunk_schema(kind: str) -> str:
    return f"conv_id {kind}, sid long, {_META}, lines {LINES}, codes binary, digests array<binary>"


class _Chunk:
    """Rows of one conversation, in order."""

    def __init__(self, conv):
        self.conv, self.first_of_conv = conv, True
        self.clear()

    def clear(self) -> None:
        self.roles, self.texts, self.codes, self.digests = [], [], bytearray(), []
        self.seen, self.bytes = set(), 0
        self.min_turn = self.max_turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, code: int, digest: bytes) -> None:
        if turn is not None:
            if turn != self.max_turn:
                self.turns += 1
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        if code % 4 != BLANK and digest in self.seen:
            code = code - code % 4 + DUPLICATE
        self.seen.add(digest)
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)
        self.digests.append(digest)
        self.bytes += len(text) + len(role)

    def row(self, sid: int, steps: Steps, is_open: bool) -> tuple:
        faults = [c % 4 for c in self.codes]
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        ends = (initials[0], initials[-1]) if initials else (None, None)
        roles, texts, cost, audit, codes, digests = self.roles, self.texts, None, None, bytes(self.codes), self.digests
        if not is_open:
            audit, cost, _ = trace(steps, codes, backward(steps, codes, END), START, True)
            roles, texts = apply_edits(roles, texts, audit, START)
            codes = digests = None
        return (self.conv, sid, is_open, self.min_turn, self.max_turn, self.turns, faults.count(BLANK), faults.count(DUPLICATE),
                faults.count(TRUNCATED), illegal, *ends, cost, audit, (roles, texts), codes, digests)


def _lines(pairs: list[tuple[list[str], list[str]]]) -> pa.ListArray:
    offsets = [0]
    for r, _ in pairs:
        offsets.append(offsets[-1] + len(r))
    fields = [pa.array([x for p in pairs for x in p[k]], pa.string()) for k in range(2)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names=["role", "text"]))


def _batched(rows: Iterable[tuple], names: list[str], types: list, weight) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded weight; lines are given as (roles, texts)."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        cols = zip(*held, strict=True)
        return pa.record_batch([_lines(list(c)) if n == "lines" else pa.array(c, t) for n, t, c in zip(names, types, cols, strict=True)], names=names)

    for r in rows:
        held.append(r)
        size += weight(r)
        if size >= CHUNK_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _arrow(schema) -> tuple[list[str], list]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [f.name for f in schema.fields], [to_arrow_type(f.dataType) for f in schema.fields]


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One stored row per chunk (``_chunk_schema``). Closed ones hold a whole, repaired conversation; open ones a
    part of one, as it is, or one at a border of a partition."""
    spark = rows.sparkSession
    kind = rows.schema["conv_id"].dataType.simpleString()
    names, types = _arrow(spark.createDataFrame([], _chunk_schema(kind)).schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        steps, sid = Steps(), TaskContext.get().partitionId() << 33
        at, border = None, True  # a partition's first conversation may have begun in the one before
        for b in batches:
            for conv, turn, role, text, code, digest, dropped in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at is None or conv != at.conv:
                    if at is not None:
                        yield at.row(sid, steps, border or not at.first_of_conv)
                        sid, border = sid + 1, False
                    at = _Chunk(conv)
                elif not dropped and at.codes and (len(at.codes) >= chunk_rows or at.bytes + len(text) > chunk_bytes):
                    yield at.row(sid, steps, True)
                    sid, at.first_of_conv = sid + 1, False
                    at.clear()
                if not dropped:
                    at.add(turn, role, text, code, digest)
        if at is not None:
            yield at.row(sid, steps, True)

    weight = lambda r: 200 + sum(map(len, r[14][1])) + 40 * len(r[14][1])
    df = _prepared(rows).mapInArrow(lambda it: _batched(cut(it), names, types, weight), _chunk_schema(kind))
    path = shared_dir(spark, "conversation-chunks")
    df.write.partitionBy("is_open").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- chunks of one conversation


def _per_row(df: DataFrame, schema: str, make, keep: list[str]) -> DataFrame:
    """``keep`` columns and what ``make`` returns for a row (a dict of all columns) as further ones."""
    names, types = _arrow(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for b in batches:
            rows = ((*(r[c] for c in keep), *make(steps, r)) for r in b.to_pylist())
            yield from _batched(rows, names, types, lambda r: sum(len(x) for x in r if isinstance(x, bytes)) + 200)

    return df.mapInArrow(run, schema)


def _streamed(df: DataFrame, schema: str, make, descending: bool = False) -> DataFrame:
    """Rows of each conversation in order of ``sid``, through a generator over one conversation's rows."""
    names, types = _arrow(df.sparkSession.createDataFrame([], schema).schema)
    sid = F.col("sid").desc() if descending else F.col("sid")

    def convs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, step = None, None
        for b in batches:
            for r in b.to_pylist():
                if step is None or r["conv_id"] != at:
                    if step is not None:
                        yield from step(None)
                    at, step = r["conv_id"], make()
                yield from step(r)
        if step is not None:
            yield from step(None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(convs(batches), names, types, lambda r: 200)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", sid).mapInArrow(run, schema)


def _with_duplicates(open_: DataFrame, kind: str) -> DataFrame:
    """Codes of open chunks, with the rows that repeat a row of an earlier chunk marked."""
    part = open_.select("conv_id", "sid", F.posexplode("digests").alias("at", "digest"))
    # an earlier row of the same chunk is known already: a chunk's first row of a digest speaks for all of them
    firsts = part.groupBy(F.col("conv_id").alias("first_conv"), F.col("digest").alias("first_digest")).agg(F.min("sid").alias("first_sid"))
    same = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("digest") == F.col("first_digest")) & (F.col("sid") > F.col("first_sid"))
    late = part.join(firsts, same).groupBy(F.col("sid").alias("late_sid")).agg(F.collect_list("at").alias("late"))  # at most a chunk's rows
    last = F.lead("sid").over(Window.partitionBy("conv_id").orderBy("sid")).isNull()
    light = open_.select("conv_id", "sid").select("sid", last.alias("is_last"))
    d = open_.select("conv_id", "sid", "codes").join(light, "sid").join(late, F.col("sid") == F.col("late_sid"), "left").drop("late_sid")

    def mark(steps: Steps, r: dict) -> tuple:
        codes = bytearray(r["codes"])
        for k in r["late"] or ():
            if codes[k] % 4 != BLANK:
                codes[k] += DUPLICATE - codes[k] % 4
        end = END if r["is_last"] else SPECULATIVE
        return bytes(codes), end, backward(steps, codes, end)[0]

    schema = f"conv_id {kind}, sid long, is_last boolean, codes binary, end_vec array<long>, start_vec array<long>"
    return stored(_per_row(d, schema, mark, ["conv_id", "sid", "is_last"]), "conversation-vectors")


def _settled(v: DataFrame, kind: str, max_fixups: int) -> tuple[DataFrame, int]:
    """Chunks with their true vectors, up to a constant, and the number of fix-up passes made."""
    spark = v.sparkSession
    schema = f"conv_id {kind}, sid long, is_last boolean, codes binary, moved boolean, end_vec array<long>, start_vec array<long>"

    def fix(steps: Steps, r: dict) -> tuple:
        if not r["moved"]:
            return r["end_vec"], r["start_vec"]
        end = tuple(r["next_vec"])
        return end, rerun(steps, r["codes"], end, tuple(r["end_vec"]), tuple(r["start_vec"]))

    for k in range(max_fixups):
        nxt = F.lead("start_vec").over(Window.partitionBy("conv_id").orderBy("sid"))
        light = v.select("conv_id", "sid", "start_vec").select("sid", nxt.alias("next_vec"))
        d = v.join(light, "sid").withColumn("moved", F.coalesce(~F.col("is_last") & (F.col("next_vec") != F.col("end_vec")), F.lit(False)))
        obs = Observation()
        run = _per_row(d, schema, fix, ["conv_id", "sid", "is_last", "codes", "moved"])
        v = stored(run.observe(obs, F.count_if("moved").alias("n")), "conversation-vectors")
        if not obs.get["n"]:
            return v, k + 1
    # what is left: exact from the chunks' transfer matrices, one light row a chunk
    mats = _per_row(v.select("conv_id", "sid", "codes"), f"conv_id {kind}, sid long, m array<long>",
                    lambda steps, r: (matrix(steps, r["codes"]),), ["conv_id", "sid"])

    def stitch():
        end = END

        def step(r):
            nonlocal end
            if r is not None:
                yield r["sid"], end
                end = applied(r["m"], end)

        return step

    ends = _streamed(mats, "sid long, end_vec array<long>", stitch, descending=True)
    return stored(v.drop("end_vec").join(ends, "sid"), "conversation-vectors"), max_fixups


def _repaired_open(open_: DataFrame, kind: str, max_fixups: int) -> DataFrame:
    """Open chunks with counts, edits, cost and lines filled in."""
    v, _ = _settled(_with_duplicates(open_, kind), kind, max_fixups)
    v = v.select("conv_id", "sid", "is_last", "codes", "end_vec")

    def exits(steps: Steps, r: dict) -> tuple:
        vectors = backward(steps, r["codes"], tuple(r["end_vec"]))
        return ([trace(steps, r["codes"], vectors, s, False)[2] for s in range(4)],)

    def walk():
        state = START

        def step(r):
            nonlocal state
            if r is not None:
                yield r["sid"], state
                state = r["exits"][state]

        return step

    entries = _streamed(_per_row(v, f"conv_id {kind}, sid long, exits array<int>", exits, ["conv_id", "sid"]), "sid long, state int", walk)
    codes = v.select("sid", "is_last", F.col("codes").alias("true_codes"), "end_vec")
    d = open_.drop("digests").join(codes, "sid").join(entries, "sid")

    def finish(steps: Steps, r: dict) -> tuple:
        codes = r["true_codes"]
        faults = [c % 4 for c in codes]
        audit, cost, _ = trace(steps, codes, backward(steps, codes, tuple(r["end_vec"])), r["state"], r["is_last"])
        lines = apply_edits([x["role"] for x in r["lines"]], [x["text"] for x in r["lines"]], audit, r["state"])
        return faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), cost, audit, lines

    keep = ["conv_id", "sid", "min_turn", "max_turn", "turns", "illegal", "first_initial", "last_initial"]
    schema = (f"conv_id {kind}, sid long, min_turn long, max_turn long, turns long, illegal long, first_initial string, last_initial string, "
              f"blank long, duplicate long, truncated long, cost long, audit string, lines {LINES}")
    return _per_row(d, schema, finish, keep).withColumn("is_open", F.lit(True))


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def repaired(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES, max_fixups: int = MAX_FIXUPS) -> DataFrame:
    """Repair ``conv_id, turn, role, text, dropped``. One row per chunk: ``conv_id, sid`` (the order), counts and
    the chunk's edits as ``audit``, their cost, and the repaired ``lines``."""
    got = chunks(rows, chunk_rows, chunk_bytes)
    kind = rows.schema["conv_id"].dataType.simpleString()
    closed = got.where(~F.col("is_open")).drop("codes", "digests")
    return closed.unionByName(_repaired_open(got.where("is_open"), kind, max_fixups))


def _wrapped(n: int) -> int:
    """As a 64-bit number, like the JVM."""
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def summary(repaired_chunks: DataFrame) -> DataFrame:
    """Per conversation ``RESULT`` and ``repaired_sha256``, the digest of the repaired lines, ``role:text``."""
    kind = repaired_chunks.schema["conv_id"].dataType.simpleString()
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    whole = repaired_chunks.where(~F.col("is_open")).withColumn("gaps", gaps).select(*RESULT, F.sha2(as_text(F.col("lines")), 256).alias("repaired_sha256"))

    def total():
        sums, audit, sha = [0] * 6, [], hashlib.sha256()
        low = high = initial = conv = None
        lines = False

        def step(r):
            nonlocal low, high, initial, lines, conv
            if r is None:
                gaps = high - low + 1 - sums[5] if low is not None else 0
                yield conv, _wrapped(gaps), *sums[:5], "".join(audit), sha.hexdigest()
                return
            conv = r["conv_id"]
            for k, c in enumerate(("blank", "duplicate", "truncated", "illegal", "cost", "turns")):
                sums[k] += r[c]
            if r["min_turn"] is not None:
                if r["min_turn"] == high:  # counted in the chunk before
                    sums[5] -= 1
                low, high = r["min_turn"] if low is None else low, r["max_turn"]
            if r["first_initial"] is not None:
                if initial is not None and initial + r["first_initial"] not in ("su", "ua", "au"):
                    sums[3] += 1
                initial = r["last_initial"]
            audit.append(r["audit"])
            for x in r["lines"]:
                if lines:
                    sha.update(b"\n")
                lines = True
                sha.update(f"{x['role']}:{x['text']}".encode("utf-8", "surrogatepass"))

        return step

    schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    parts = _streamed(repaired_chunks.where("is_open"), schema, total)
    return whole.unionByName(parts)


def as_text(column: Column) -> Column:
    """Repaired lines of a chunk as text, one per line."""
    return F.array_join(F.transform(column, lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
