"""Conversation structure repair by a Viterbi decoder whose chunks run in parallel.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``.  Edits make it right at the least cost: Keep (0), Rerole to user
or assistant (3), Delete (4; the only edit of blank and duplicate rows), Insert an empty user or assistant turn anywhere (3); a truncated row that
isn't deleted adds 3.  Of the cheapest lists of edits the one whose initials are least in ASCII is taken: the audit.

The automaton has four states (start, after system, after user, after assistant).  A vector holds the least cost to go from each
of them; a row maps the vector after it to the one before it, and adding a constant to a vector changes no decision.  So
(rank convergence, Maleki et al. 2014):

1. rows are numbered in their order by a range partitioning and cut into chunks of at most ``chunk_rows``; a conversation of a third of all rows is many chunks;
2. each chunk runs backward from a speculative vector, that of a conversation's end;
3. fix-up passes: a chunk whose successor's vector isn't the one it began from, but for a constant, runs again from that; this ends
   when all are equal but for a constant, commonly after one or two passes.  There are chunks that never forget where they began (users only, say).
   Chunks that ``max_passes`` passes haven't settled get the vectors of all four unit starts, which compose exactly in one sweep over their conversation;
4. the stitched vectors drive the tracing: for each state in which a chunk may be entered the least audit is known without
   the other chunks, states are handed on in a sweep over chunks, and each chunk writes its edits.

Only codes of rows go through 1 to 4, never texts.  Texts are shuffled to their edits and then to their conversation, where a
SHA-256, which is sequential, takes them up row by row (one task streams a conversation, a batch in memory).  Rows alike in conversation,
turn, role and text are one row with a count, so their number costs nothing but the length of the audit.

Defined cases: nulls in role and text are one space (so blank, and no legal role), in conv_id and turn one space of the key of the damage; a null conv_id is a
conversation of its own; turns that are null come first; rows of one turn are ordered by role (its first 32 characters), text (its first 16), then role, text (256) and its
SHA-256; no rows after damage: zeros, an empty audit, the hash of the empty string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.plans.shared import staged

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted turn leads to, from each state, and that rows of each initial lead to.
NEXT = (USER, USER, ASSISTANT, USER)
LEGAL = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
INITIALS = "?sua"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Costs to go at a conversation's end: nothing is missing, or the turns that must be inserted.
END = (0, 6, 3, 0)
#: The code of a row is twice its initial, and one more if it's truncated; a row that must go has this one.
GONE = 8
FAR = 1 << 40
SPACES = " \t\n\x0b\x0c\r"
Vector = tuple[int, int, int, int]


def normal(v) -> Vector:
    return tuple(int(x) - int(min(v)) for x in v)


@cache
def step(code: int, after: Vector) -> tuple[Vector, int, tuple[tuple[str, int], ...]]:
    """Before a row: the vector less its least element, that element, and for each state the least edits up to the row and the state after it.

    There are few vectors, as an insertion leads from any state to the next at 3, so rows after the first thousands are looked up.
    """
    best: list[list[tuple[int, str, int]]] = []
    for state in range(4):
        ways = [(DELETE + after[state], "D", state)]
        if code != GONE:
            extra = TRUNCATED * (code & 1)
            kept = LEGAL.get(INITIALS[code >> 1], {}).get(state)
            ways += [(extra + after[kept], "K", kept)] if kept is not None else []
            ways += [(REROLE + extra + after[NEXT[state]], "R", NEXT[state])]
        best.append(min(ways))
    for _ in range(2):  # inserted turns before the row: two at most
        best = [min(best[x], (INSERT + best[NEXT[x]][0], "I" + best[NEXT[x]][1], best[NEXT[x]][2])) for x in range(4)]
    low = min(b[0] for b in best)
    return tuple(b[0] - low for b in best), low, tuple((b[1], b[2]) for b in best)


def backward(codes: bytes, after: Vector) -> list[Vector]:
    """The vectors after each row, and last that before the first one; all normal."""
    out = [after]
    for code in reversed(codes):
        out.append(step(code, out[-1])[0] if code != GONE else out[-1])
    return out[:-1][::-1] + out[-1:]


def unit_costs(codes: bytes, runs: list[int]) -> list[int]:
    """Row by row a 4 x 4 table: the least cost from a state before the chunk to one after it; FAR where there is no way."""
    tables = []
    for target in range(4):
        v, base = tuple(0 if x == target else FAR for x in range(4)), 0
        for _ in range(2):
            v = tuple(min(v[x], INSERT + v[NEXT[x]]) for x in range(4))
        for code, n in zip(reversed(codes), reversed(runs)):
            if code == GONE:
                base += DELETE * n
            else:
                v, low, _ = step(code, v)
                v, base = tuple(x if x < FAR // 2 else FAR for x in v), base + low
        tables.append([x + base if x < FAR else FAR for x in v])
    return [tables[target][state] for state in range(4) for target in range(4)]


def trace(codes: bytes, runs: list[int], after: Vector, state: int, last: bool) -> tuple[int, int, list[str], list[int]]:
    """Cost, state at the end, the edits of each row (and those at a conversation's end), the state before each row."""
    vectors = backward(codes, after)
    cost, edits, states = 0, [], []
    for code, n, v in zip(codes, runs, vectors):
        states.append(state)
        if code == GONE:
            cost += DELETE * n
            edits.append("D")
            continue
        own, state = step(code, v)[2][state]
        cost += INSERT * (len(own) - 1) + {"K": 0, "R": REROLE, "D": DELETE}[own[-1]] + TRUNCATED * (code & 1) * (own[-1] != "D")
        edits.append(own)
    if last:
        states.append(state)
        edits.append("I" * (END[state] // INSERT))
        cost, state = cost + END[state], START
    return cost, state, edits, states


def damaged(turns: DataFrame) -> DataFrame:
    """key, turn, role, text after the damage; a row that is to be repeated has copies 2."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = turns.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("fate <> 0").select("key", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """From staged rows (with a number rid): one row for each (key, turn, role, text), with its code, its count, and pos, its place in the order of all rows."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    last = F.right(trimmed, F.lit(1))
    narrow = rows.select(
        "key", "turn", "role", "copies", "rid", F.sha2("text", 256).alias("same"), F.substring("text", 1, 16).alias("t16"), F.substring("text", 1, 256).alias("t256"),
        (trimmed == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )
    about = ["key", "turn", "role", "same", "t16", "t256", "blank", "cut"]
    single = narrow.groupBy(*about).agg(F.min("rid").alias("rid"), F.sum("copies").alias("n"))
    single = staged(single.withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), "turn")), "turns")
    first = single.groupBy("key", "role", "same").agg(F.min("at").alias("first"))
    initial = F.substring("role", 1, 1)
    code = sum((F.when(initial == c, F.lit(2 * i)).otherwise(F.lit(0)) for i, c in enumerate(INITIALS) if i), F.lit(0)) + F.col("cut").cast("int")
    rows = single.join(first, ["key", "role", "same"]).withColumn("again", F.col("at") > F.col("first"))
    rows = rows.select(*about, "rid", "n", "again", F.when(F.col("blank") | F.col("again"), F.lit(GONE)).otherwise(code).alias("code"), initial.alias("initial"), F.substring("role", 1, 32).alias("r32"))
    order = ["key", F.col("turn").asc_nulls_first(), "r32", "t16"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "role", "t256", "same")
    return staged(rows.select("key", "turn", "role", "rid", "n", "code", "blank", "again", "cut", "initial", F.monotonically_increasing_id().alias("pos")), "ordered")


PIECES = "key string, seq long, codes binary, runs array<long>, positions array<long>, illegal long, first string, last string"


def _pieces(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """One row for each chunk of each conversation: at most chunk_rows of its rows, in order; seq orders the chunks."""
    fields = [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunk, done = None, None, []
        codes, runs, positions, initials, illegal = bytearray(), [], [], [], 0

        def close() -> None:
            if positions:
                done.append((key, positions[0], bytes(codes), runs, positions, illegal, initials[0], initials[-1]))

        for frame in frames:
            for k, c, pos, code, n, initial in zip(*(col.to_pylist() for col in frame.columns)):
                if k != key or c != chunk:
                    close()
                    key, chunk, codes, runs, positions, initials, illegal = k, c, bytearray(), [], [], [], 0
                if initials:
                    illegal += initials[-1] + initial not in ("su", "ua", "au")
                illegal += n - 1  # equal roles side by side
                initials = [initials[0] if initials else initial, initial]
                codes.append(code)
                runs.append(1 if code != GONE else n)
                positions.append(pos)
                if code != GONE and n > 1:  # all but the first of equal rows are duplicates
                    codes.append(GONE)
                    runs.append(n - 1)
                    positions.append(-1)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), fields)], names)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), fields)], names)

    chunk = F.expr(f"pos div {chunk_rows}")  # the upper bits of pos are the range, so a chunk lies in one range
    rows = rows.select("key", chunk.alias("chunk"), "pos", "code", "n", "initial").repartition("chunk").sortWithinPartitions("pos")
    return rows.mapInArrow(run, PIECES)


def _mapped(rows: DataFrame, make, schema: str) -> DataFrame:
    """make gives for each row's values (in the order of columns) a tuple of schema's values."""
    fields = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}[x.split()[1]] for x in schema.split(", ")]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            out = [make(*values) for values in zip(*(c.to_pylist() for c in frame.columns))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), fields)], names)

    return rows.mapInArrow(run, schema)


def _vectors(many: DataFrame, max_passes: int) -> DataFrame:
    """(key, seq, after): for each chunk of conversations of several chunks the vector at its end, right but for a constant."""
    spec = "key string, seq long, after array<int>, before array<int>"
    run = lambda key, seq, codes, after: (key, seq, list(after), list(backward(codes, tuple(after))[-1]))
    ahead = Window.partitionBy("key").orderBy("seq")
    ends = F.array(*[F.lit(x) for x in END])
    now = staged(_mapped(many.select("key", "seq", "codes", ends), run, spec), "vectors")
    for turn in range(max_passes + 1):
        wanted = now.withColumn("wanted", F.coalesce(F.lead("before").over(ahead), ends))
        unlike = wanted.where("after <> wanted")
        if unlike.isEmpty():
            return now.select("key", "seq", "after")
        if turn == max_passes:
            break
        again = many.join(unlike.select("key", "seq", "wanted"), ["key", "seq"]).select("key", "seq", "codes", "wanted")
        again = _mapped(again, run, spec)
        now = staged(now.join(unlike.select("key", "seq"), ["key", "seq"], "left_anti").unionByName(again), "vectors")
    open_keys = unlike.select("key").distinct()
    units = _mapped(many.join(open_keys, "key", "left_semi").select("key", "seq", "codes", "runs"), lambda key, seq, codes, runs: (key, seq, unit_costs(codes, runs)), "key string, seq long, costs array<long>")
    schema = "key string, seq long, after array<int>"

    def sweep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, v = None, END
        for frame in frames:
            rows = []
            for k, seq, costs in zip(*(c.to_pylist() for c in frame.columns)):
                v = END if k != key else v
                key = k
                rows.append((k, seq, list(v)))
                v = normal([min(costs[4 * x + y] + v[y] for y in range(4)) for x in range(4)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.list_(pa.int32())))], ["key", "seq", "after"])

    swept = units.repartition("key").sortWithinPartitions("key", F.col("seq").desc()).mapInArrow(sweep, schema)
    return now.select("key", "seq", "after").join(open_keys, "key", "left_anti").unionByName(swept)


def _entries(many: DataFrame) -> DataFrame:
    """(key, seq, entry): the state in which each chunk is entered, from the states to which each chunk leads from each."""
    exits = _mapped(many.select("key", "seq", "codes", "runs", "after"), lambda key, seq, codes, runs, after: (key, seq, [trace(codes, runs, tuple(after), s, False)[1] for s in range(4)]), "key string, seq long, exits array<int>")

    def sweep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, START
        for frame in frames:
            rows = []
            for k, seq, to in zip(*(c.to_pylist() for c in frame.columns)):
                state = START if k != key else state
                key = k
                rows.append((k, seq, state))
                state = to[state]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32()))], ["key", "seq", "entry"])

    return exits.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(sweep, "key string, seq long, entry int")


def decoded(rows: DataFrame, chunk_rows: int, max_passes: int) -> DataFrame:
    """From ordered rows: each chunk with its audit, cost, illegal pairs, and lines: which rows stay (by pos) or are inserted (-1), with the new role or null."""
    pieces = staged(_pieces(rows, chunk_rows), "pieces")
    span = Window.partitionBy("key").orderBy("seq")
    about = staged(pieces.select("key", "seq", (F.lead("seq").over(span).isNull()).alias("final"), F.lag("last").over(span).alias("previous")), "chunks")
    pieces = pieces.join(about, ["key", "seq"]).withColumn("illegal", F.col("illegal") + (F.col("previous").isNotNull() & ~F.concat("previous", "first").isin("su", "ua", "au")).cast("long"))
    alone = F.col("final") & F.col("previous").isNull()
    one = pieces.where(alone).withColumns({"after": F.array(*[F.lit(x) for x in END]), "entry": F.lit(START)})
    many = staged(pieces.where(~alone), "long")
    if not many.isEmpty():
        placed = many.join(staged(_vectors(many, max_passes), "after"), ["key", "seq"])
        one = one.unionByName(placed.join(_entries(placed), ["key", "seq"]).select(one.columns))

    def edit(key, seq, illegal, codes, runs, positions, after, entry, final):
        cost, _, edits, states = trace(codes, runs, tuple(after), entry, final)
        audit, kept, roles = [], [], []
        for i, own in enumerate(edits):
            state = states[i]
            for e in own:
                if e == "D":
                    continue
                if e == "K":
                    kept.append(positions[i])
                    roles.append(None)
                else:
                    state = NEXT[state]
                    kept.append(positions[i] if e == "R" else -1)
                    roles.append("user" if state == USER else "assistant")
            audit.append(own if i == len(codes) or codes[i] != GONE else "D" * runs[i])
        return key, seq, illegal, cost, "".join(audit), kept, roles

    schema = "key string, seq long, illegal long, cost long, audit string, kept array<long>, roles array<string>"
    return _mapped(one.select("key", "seq", "illegal", "codes", "runs", "positions", "after", "entry", "final"), edit, schema)


def _streamed(lines: DataFrame) -> DataFrame:
    """(key, audit, repaired_sha256) of each conversation, from its chunks' audits and its lines in order."""
    schema = "key string, audit string, repaired_sha256 string"

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, begun, audit, done = None, hashlib.sha256(), False, [], []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["key", "audit", "repaired_sha256"])
        for frame in frames:
            for k, piece, role, text in zip(*(c.to_pylist() for c in frame.columns)):
                if k != key:
                    if key is not None:
                        done.append((key, "".join(audit), digest.hexdigest()))
                    key, digest, begun, audit = k, hashlib.sha256(), False, []
                if piece is not None:
                    audit.append(piece)
                else:
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    begun = True
            if done:
                yield pack()
                done = []
        if key is not None:
            done.append((key, "".join(audit), digest.hexdigest()))
            yield pack()

    return lines.repartition("key").sortWithinPartitions("key", "seq", "nr").select("key", "audit", "role", "text").mapInArrow(run, schema)


def repair(turns: DataFrame, chunk_rows: int = 4096, max_passes: int = 5) -> DataFrame:
    """Damages conversations (conv_id, turn, role, text) and repairs them: a row for each conv_id."""
    rows = staged(damaged(turns).withColumn("rid", F.monotonically_increasing_id()), "damaged")
    ordered = _ordered(rows)
    chunks = staged(decoded(ordered, chunk_rows, max_passes), "decoded")
    live = ~F.col("blank") & ~F.col("again")
    n = F.col("n")
    # Of rows with a count that aren't blank or seen before, the first may be truncated and the others are duplicates.
    counted = ordered.groupBy("key", "turn").agg(*[F.sum(c).alias(a) for a, c in {"blank": F.when(F.col("blank"), n).otherwise(0), "duplicate": F.when(F.col("blank"), 0).when(F.col("again"), n).otherwise(n - 1), "truncated": (live & F.col("cut")).cast("long")}.items()])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    counted = counted.groupBy("key").agg(gaps, *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    sums = chunks.groupBy("key").agg((F.sum("illegal")).alias("illegal"), F.sum("cost").alias("cost"))
    lines = chunks.select("key", "seq", F.posexplode(F.arrays_zip("kept", "roles")).alias("nr", "line")).select("key", "seq", "nr", F.col("line.kept").alias("pos"), F.col("line.roles").alias("new"))
    own = lines.where("pos >= 0").join(ordered.select("pos", "rid", "role"), "pos").join(rows.select("rid", "text"), "rid").select("key", "seq", "nr", F.lit(None).cast("string").alias("audit"), F.coalesce("new", "role").alias("role"), "text")
    inserted = lines.where("pos < 0").select("key", "seq", "nr", F.lit(None).cast("string").alias("audit"), F.col("new").alias("role"), F.lit("").alias("text"))
    audits = chunks.select("key", "seq", F.lit(-1).alias("nr"), "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    found = counted.join(sums, "key").join(_streamed(own.unionByName(inserted).unionByName(audits)), "key")
    every = turns.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("key")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return every.join(found, "key", "left").select(
        F.nullif("key", F.lit("")).cast("long").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
