"""Conversation repair against plain search, and against a table of whole strings; nulls, ties, repeats, a long conversation."""

import hashlib
import heapq
import itertools
import random
import zlib

from graphloom.llm import conversation_repair as cr
from graphloom.llm import queries

NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def best(rows):
    """The least (cost, edits) over all repairs, by Dijkstra's search over (place, row) with whole strings; rows: (initial, fault)."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, place, k = heapq.heappop(heap)
        if k == len(rows) and place in (0, 3):
            return cost, audit
        if (place, k) in done:
            continue
        done.add((place, k))
        heapq.heappush(heap, (cost + 3, audit + "I", NEXT[place][0], k))
        if k < len(rows):
            initial, fault = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", place, k + 1))
            if fault not in (cr.BLANK, cr.DUPLICATE):
                more = 3 if fault == cr.TRUNCATED else 0
                heapq.heappush(heap, (cost + 3 + more, audit + "R", NEXT[place][0], k + 1))
                if (place, initial) in KEPT:
                    heapq.heappush(heap, (cost + more, audit + "K", KEPT[place, initial], k + 1))
    raise AssertionError


def streamed(rows):
    repair = cr.Repair()
    out = [e for k, (i, f) in enumerate(rows) for e in repair.push(i, f, k)] + list(repair.finish())
    assert [k for e, k in out if k is not None] == list(range(len(rows)))
    return repair.cost, "".join(e for e, _ in out)


def test_every_short_conversation():
    for n in range(5):
        for rows in itertools.product([(i, f) for i in "sux" for f in (cr.NONE, cr.BLANK, cr.TRUNCATED)] + [("a", cr.NONE)], repeat=n):
            assert streamed(rows) == best(rows), rows


def test_random_conversations():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(rng.choice("suaaux"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(25))]
        assert streamed(rows) == best(rows), rows


def test_survivors_stand_in_the_order_of_their_undecided_edits():
    rng = random.Random(2)
    for _ in range(200):
        repair = cr.Repair()
        for k in range(40):
            list(repair.push(rng.choice("sua"), rng.choice([0, 0, 3]), k))
            undecided = []
            for _, _, node in repair.live:
                edits = []
                while node is not repair.root:
                    edits.append(node.edits)
                    node = node.parent
                undecided.append("".join(reversed(edits)))
            assert undecided == sorted(undecided) and len(set(undecided)) == len(undecided)


def test_decided_edits_leave_the_tree():
    repair, most = cr.Repair(), 0
    for k in range(20_000):
        list(repair.push("ua"[k % 2] if k % 50 else "s", cr.NONE, k))
        most = max(most, len(repair.rows))
    assert most < 100


def by_hand(rows):
    """The query's rows from (conv_id, turn, role, text) in plain Python."""
    talks = {}
    for conv, turn, role, text in rows:
        talk = talks.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        talk += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, talk in talks.items():
        solid = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").decode()
        when = lambda r: (r[0] is not None, r[0] or 0)
        first = {}
        for r in sorted(talk, key=when):
            first.setdefault(r[1:], r[0])
        talk.sort(key=lambda r: (*when(r), r[1], solid(r[2]) != "" and first[r[1:]] == r[0], r[2].encode()))
        seen, faults = set(), []
        for r in talk:
            faults.append(cr.BLANK if not solid(r[2]) else cr.DUPLICATE if r[1:] in seen else cr.TRUNCATED if solid(r[2])[-1] not in ".!?" else cr.NONE)
            seen.add(r[1:])
        cost, audit = best([(r[1][:1], f) for r, f in zip(talk, faults, strict=True)])
        place, left, lines = 0, list(talk), []
        for e in audit:
            row = left.pop(0) if e != "I" else None
            if e == "K":
                place = KEPT[place, row[1][:1]]
                lines.append(f"{row[1]}:{row[2]}")
            elif e != "D":
                place, role = NEXT[place]
                lines.append(f"{role}:{row[2] if row else ''}")
        turns = {r[0] for r in talk if r[0] is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(talk))
        yield (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (cr.BLANK, cr.DUPLICATE, cr.TRUNCATED)], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def made(rng, convs):
    words = ["Yes.", "No!", "why", "Is it so?", "It is", "  ", "\t\n", "", None, "Well. \n", "é.", "a:b\nuser:c."]
    rows = [(rng.choice([*range(convs), None]), rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(words)) for _ in range(convs * 9)]
    return rows + rows[:20] + rows[:5]


def test_query_against_plain_python(spark, tmp_path):
    rng = random.Random(5)
    rows = made(rng, 60) + [(1000, k, "ua"[k % 2] == "u" and "user" or "assistant", f"line {k}.") for k in range(1500)] + [(2000, 3, "user", "Hi.")]
    rows += [(c, None, None, None) for c in range(3000, 3040)]  # some are dropped whole
    frame = spark.createDataFrame([(*r, 7, "old") for r in rows], "conv_id long, turn long, role string, text string, fault int, marker string").repartition(6)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(by_hand(rows), key=str)
    repaired = cr.repair(queries.damaged(frame)).collect()
    for conv in (1000, 5, None):
        lines = [f"{r.role}:{r.text}" for r in sorted([r for r in repaired if r.conv_id == conv], key=lambda r: r.seq)]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == next(r.repaired_sha256 for r in got if r.conv_id == conv)
    assert cr.summaries(frame.where("false")).count() == cr.repair(frame.where("false")).count() == 0


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    import duckdb

    rows = [r for r in made(random.Random(8), 25) if r[2] != ""]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(f"SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ({queries.ORACLE_SQL['op12_conversation_repair']})").fetchall(), key=str) == sorted(by_hand(rows), key=str)
