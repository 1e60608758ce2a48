"""Conversation repair, filter audit and WARC archives, by brute force and exact round trips."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
import zstandard
from oracle import cell, connect, rows

from ledgerloom.llm import filter_audit, queries, repair, warc
from ledgerloom.plans.shared import fresh_path

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, key string, seq int, pos double"


@pytest.mark.parametrize("name", ["op11_repair", "op12_filter_audit", "op13_warc"])
def test_same_rows_as_sql(spark, name):
    ours = queries.queries()[name](spark, SMALL).toPandas()
    theirs = connect().execute(queries.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours)
    assert rows(ours) == rows(theirs)


# Repair


def damage(turns):
    out = defaultdict(list)
    for conv, turn, role, text in turns:
        out[conv]
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out[conv] += [(turn, "user" if fate == 4 else role, text)] * (1 + (fate == 3))
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def repaired(conversation):
    """Forward over all edits, with audits and repaired rows in full."""
    faults, seen = [], set()
    for _, role, text in conversation:
        bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(3):
            new = dict(ways)
            for state, (cost, audit, lines) in ways.items():
                for c in "ua":
                    if (to := legal.get((state, c))) is not None:
                        new[to] = min(new.get(to, (9**9,)), (cost + 3, audit + "I", [*lines, f"{names[c]}:"]))
            ways = new
        return ways

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(conversation, faults):
        new = {}
        offer = lambda to, way: new.update({to: min(new.get(to, (9**9,)), way)})  # noqa: E731, B023
        for state, (cost, audit, lines) in inserted(ways).items():
            offer(state, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] in "sua" and (to := legal.get((state, role[:1]))) is not None:
                    offer(to, (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
                for c in "ua":
                    if (to := legal.get((state, c))) is not None:
                        offer(to, (cost + extra + 3, audit + "R", [*lines, f"{names[c]}:{text}"]))
        ways = new
    cost, audit, lines = min(w for s, w in inserted(ways).items() if s in ("", "a"))
    turns = [t for t, _, _ in conversation if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(conversation, conversation[1:]))
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def odd_turns(seed, n=500):
    r = random.Random(seed)
    texts = [None, "", " \n", "Yes.", "No", "Go on!", "A? ", "b.\t", "x" * 300 + ".", "Well"]
    out = [(r.choice([1, 2, 3, 4, None, 5, 6, 7, 7, 7]), r.choice([*range(40), None]), r.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]), r.choice(texts)) for _ in range(n)]
    out += [(20, i, "user", f"Only users {i}.") for i in range(60)]  # chunks of these never forget where they began
    out += [(21, 5, "user", "again.")] * 50 + [(21, 5 + i, "assistant" if i % 2 else "user", f"w{i}.") for i in range(30)]
    out += [(22, None, "system", "S."), (22, None, "user", "q?"), (22, None, "assistant", "a.")]
    dropped = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return out + [(dropped, 0, "user", "Gone."), (30, 0, "tool", "t."), (31, 3, "system", "Alone.")]


@pytest.mark.parametrize(("chunk_rows", "max_passes"), [(4096, 5), (1, 1), (3, 0)])
def test_repair_equals_brute_force(spark, chunk_rows, max_passes):
    turns = odd_turns(chunk_rows)
    frame = spark.createDataFrame([(*t, "k", 1, 0.5) for t in turns], TURNS).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(frame, chunk_rows, max_passes).collect()}
    assert got == {conv: repaired(c) for conv, c in damage(turns).items()}


def test_repair_of_nothing(spark):
    assert repair.repair(spark.createDataFrame([], TURNS)).count() == 0


def test_passes_end_when_vectors_are_alike(spark, monkeypatch):
    """A long conversation of alternating roles settles without the unit vectors; one of users only needs them."""
    used = []
    monkeypatch.setattr(repair, "unit_costs", lambda *a: used.append(1) or [0] * 16)
    turns = [(1, i, "assistant" if i % 2 else "user", f"Text {i}.") for i in range(200)]
    frame = spark.createDataFrame([(*t, "k", 1, 0.5) for t in turns], TURNS)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(frame, 16, 4).collect()}
    assert got == {1: repaired(damage(turns)[1])}


def test_vectors_are_few():
    """All vectors that rows of any code can lead to from a conversation's end: a bounded table of steps."""
    seen, work = {repair.END}, [repair.END]
    while work:
        v = work.pop()
        for code in range(8):
            before = repair.step(code, v)[0]
            if before not in seen:
                seen.add(before)
                work.append(before)
    assert len(seen) < 100


# Filter audit

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask int, part string, good double"


def odd_files(spark, folder):
    """Eight files; smaller ids of a text come later, some in the same file."""
    r = random.Random(5)
    long, shout = " ".join(f"w{i}" for i in range(80)), "LOUD " * 60
    texts = [None, "", "short", long, long + " #", shout, "same words " * 60, long + "!", long + "?" * 3]
    docs = [(i, r.choice(texts), "en", r.choice(["a", "b", None, ""]), 1, 7, "p", 0.5) for i in range(300)]
    docs += [(None, long, "en", "a", 1, 7, "p", 0.5), (None, None, "en", "b", 1, 7, "p", 0.5), (3, docs[3][1], "en", "b", 1, 7, "p", 0.5), (299, "x " * 40000, "en", "b", 1, 7, "p", 0.5)]
    r.shuffle(docs)
    for k in range(8):
        spark.createDataFrame(docs[k::8], DOCS).coalesce(1).write.mode("append").parquet(folder)
    return docs


def audited(docs, good, toxic):
    least, parts = {}, defaultdict(list)
    for doc_id, text, _, _, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, text, _, source, *_ in docs:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > least[text]}
        parts[source or ""].append(("".join(k for k, v in fails.items() if v), doc_id in good, doc_id in toxic))
    out = set()
    for part, of in parts.items():
        removed, lines = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = of
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                removed[x] += len(gone)
                lines.append((part, order, step, x, len(left), len(gone), sum(x in d[0] for d in of) - len(gone), sum(d[0] == x for d in of), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out |= {(*line[:3], *line[4:], removed[line[3]]) for line in lines}
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_audit_equals_brute_force(spark, batches):
    folder = fresh_path(spark, "audit-docs")
    docs = odd_files(spark, folder)
    marks = [(i, i % 3 == 0, i % 7 == 0) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1), (6, None, None)]
    labels = spark.createDataFrame([(d, None if g is None else int(g), None if t is None else int(t)) for d, g, t in marks], "doc_id long, quality int, toxic int")
    good, toxic = {d for d, g, _ in marks if g and d is not None}, {d for d, _, t in marks if t and d is not None}
    got = filter_audit.audit(spark, folder, labels, batches=batches)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in got.select(names).collect()} == audited(docs, good, toxic)


def test_audit_goes_on_from_its_checkpoint(spark):
    """Files that come later retract what the first ones counted; a run without new files changes nothing."""
    folder, state = fresh_path(spark, "audit-more"), fresh_path(spark, "audit-state")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    late = lambda rows: spark.createDataFrame([(*r, "en", "s", 1, 0, "p", 0.0) for r in rows], DOCS).coalesce(1).write.mode("append").parquet(folder)
    late([(9, "t"), (8, "t"), (7, "u")])
    counts = lambda: {(r.mask & 16, r.n) for r in filter_audit.count_masks(spark, folder, labels, state).collect()}
    assert counts() == {(0, 2), (16, 1)}
    late([(2, "t"), (9, "u")])
    deltas = []
    assert counts() == counts() == {(0, 2), (16, 3)}
    deltas = [r.delta for r in spark.read.parquet(f"{state}/deltas").collect()]
    assert sum(deltas) == 5


def test_audit_of_nothing(spark):
    folder = fresh_path(spark, "audit-none")
    spark.createDataFrame([], DOCS).write.parquet(folder)
    assert filter_audit.audit(spark, folder, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# WARC

PAGES = "page_id long, url string, html string, row double, same string, payload int"


def odd_pages(spark):
    pages = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2 b\r\nX: y", "<p>one</p>"), (3, None, "<p>one</p>"), (None, "http://a/4", "<p>one</p>"), (5, "u", None), (6, "u", ""), (7, "u", "Ünï 😀 P*M\x18\0\0\0\0"), (8, "u", "long " * 400000), (1, "http://a/1", "<p>one</p>"), (9, "u", "\r\n\r\nWARC/1.1\r\n"), (None, None, "alone"), (None, None, "alone")]
    return pages, spark.createDataFrame([(*p, 0.5, "s", 3) for p in pages], PAGES)


@pytest.mark.parametrize("archive_bytes", [1, 1 << 24])
@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_archives_round_trip(spark, least, archive_bytes):
    pages, frame = odd_pages(spark)
    folder = warc.write_archives(frame, fresh_path(spark, "warc"), least_bytes=least, archive_bytes=archive_bytes)
    read = warc.read_archives(spark, folder).collect()
    classes = defaultdict(list)
    for page_id, _, html in pages:
        classes[(html or "").encode()].append(page_id)
    want = []
    for data, ids in classes.items():
        first, *rest = sorted(ids, key=lambda i: (i is None, i or 0))
        about = len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()
        want += [(first, *about, "response", None)] + [(i, *about, "revisit", first) if len(data) >= least else (i, *about, "response", None) for i in rest]
    order = lambda rs: sorted(rs, key=lambda r: tuple(map(cell, r)))
    assert order(tuple(r)[:5] for r in read) == order(want)
    back = sorted((cell(r.page_id), bytes(r.payload)) for r in warc.restored(spark, folder).collect())
    assert back == sorted((cell(i), (h or "").encode()) for i, _, h in pages)


def test_archives_of_nothing(spark):
    folder = warc.write_archives(spark.createDataFrame([], PAGES), fresh_path(spark, "warc"))
    assert warc.read_archives(spark, folder).count() == 0


def test_an_archive_is_plain_warc(spark):
    """Each record alone is a frame that the zstandard library decodes with the dictionary of the leading frame."""
    _, frame = odd_pages(spark)
    folder = warc.write_archives(frame.coalesce(1), fresh_path(spark, "warc"))
    data = bytes(spark.read.format("binaryFile").load(folder).first().content)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    records = list(warc.frames_of(data))
    own = warc.opener(data[8 : 8 + int.from_bytes(data[4:8], "little")])
    for at, content in records:
        assert zstandard.ZstdDecompressor(dict_data=own).decompress(data[at : warc.frame_end(memoryview(data), at)]) == content
        assert content.startswith(b"WARC/1.1\r\n") and content.endswith(b"\r\n\r\n")
    packed = warc.skippable(warc.DICTIONARY, zstandard.ZstdCompressor().compress(data[8 : 8 + int.from_bytes(data[4:8], "little")]))
    assert [c for _, c in warc.frames_of(packed + data[records[0][0] :])] == [c for _, c in records]  # a dictionary may itself be compressed


def test_faults_of_archives():
    good = warc.record(1, 0, "u", b"text", None, "2020-01-01T00:00:00Z")
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(good)
    assert [c for _, c in warc.frames_of(warc.skippable(warc.DICTIONARY, b"") + frame)] == [good]
    flipped = bytearray(frame)
    flipped[-6] ^= 1
    for bad in (frame[:-5], frame + b"junk", frame + warc.skippable(warc.DICTIONARY, b""), bytes(flipped), frame + warc.skippable(0x184D2A50, b"xyz")[:-1]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames_of(bad))
    assert warc.parse(good)[1:] == (b"text", 4)
    for old, new in ((b"text\r\n\r\n", b"texts\r\n\r\n"), (b"text\r\n", b"tixt\r\n"), (b"WARC-Date", b"WARC-Dat"), (b"WARC/1.1", b"HTTP/1.1"), (b"WARC-Type", b"WARC-Type : x\r\nA"), (b"Content-Length: 4", b"Content-Length: 9"), (b"WARC-Date", b"WARC-Type: x\r\nWARC-Date")):
        with pytest.raises(ValueError):
            warc.parse(good.replace(old, new, 1))
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, 0, "u", b"text", (2, 3), "d").replace(b"WARC-Refers-To", b"X-Refers-To"))
