"""Conversation repair against a shortest-path search that tries every edit, and against its SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from functools import cache

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tickweave.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute_edits(rows):
    """Least (cost, audit) over all edit sequences; rows are (initial, must go, cut off)."""
    inserts = {0: [2], 1: [2], 2: [3], 3: [2]}

    @cache
    def best(i, state, inserted):
        options = []
        if i == len(rows):
            if state in (0, 3):
                options.append((0, ""))
        else:
            initial, must, cut = rows[i]
            moves = [("D", 2, state)]
            if not must:
                late = 5 * cut
                if initial == "s" and state == 0:
                    moves.append(("K", late, 1))
                if initial == "u" and state != 2:
                    moves.append(("K", late, 2))
                if initial == "a" and state == 2:
                    moves.append(("K", late, 3))
                moves += [("R", 1 + late, y) for y in inserts[state]]
            for c, cost, y in moves:
                rest = best(i + 1, y, 0)
                options.append((cost + rest[0], c + rest[1]))
        if inserted < 4:
            for y in inserts[state]:
                rest = best(i, y, inserted + 1)
                options.append((5 + rest[0], "I" + rest[1]))
        return min(options, default=(10**9, ""))

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for state, inserted in itertools.product(range(4), range(5)):
            best(i, state, inserted)
    return best(0, 0, 0)


def brute(rows):
    """The contract, row by row in Python."""
    after = {}
    for conv, turn, role, text in rows:
        live = after.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        live += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, live in after.items():
        live.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in live if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in live:
            stripped = text.strip(SPACE)
            faults.append("blank" if not stripped else "duplicate" if (role, text) in seen else "" if stripped[-1] in ".!?" else "truncated")
            seen.add((role, text))
        illegal = sum((x[1][:1] + y[1][:1]) not in ("su", "ua", "au") for x, y in itertools.pairwise(live))
        cost, audit = brute_edits(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(live, faults)))
        left, lines, first = iter(live), [], (len(audit) - audit.count("D")) % 2
        for edit in audit:
            row = None if edit == "I" else next(left)
            name = ("user", "assistant")[(len(lines) - first) % 2]
            if edit == "I":
                lines.append(f"{name}:")
            elif edit != "D":
                lines.append(f"{row[1] if edit == 'K' else name}:{row[2]}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4])
def test_every_short_string(length):
    roles = "suax"
    for kinds in itertools.product(range(repair.KINDS), repeat=length):
        rows = tuple((" ", True, False) if k == 0 else (roles[(k - 1) // 2], False, (k - 1) % 2 == 1) for k in kinds)
        assert repair.edits(bytes(kinds)) == brute_edits(rows), kinds


def test_long_strings():
    rng = random.Random(1)
    for _ in range(400):
        kinds = rng.choices(range(repair.KINDS), [rng.random() for _ in range(repair.KINDS)], k=rng.randrange(5, 60))
        rows = tuple((" ", True, False) if k == 0 else ("suax"[(k - 1) // 2], False, (k - 1) % 2 == 1) for k in kinds)
        assert repair.edits(bytes(kinds)) == brute_edits(rows), kinds


def fixture():
    rng = random.Random(2)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(0, 12)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "User", "ünı"])
            text = rng.choice(["Hello there.", "Cut of", " \t", "", None, "What?\n", "Größe!", "x" * 300 + rng.choice(".,"), "no. stop \x0b"])
            rows.append((conv, rng.choice([turn, turn, turn * 2, None]), role, text))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    rows += [(77, t, ("user", "assistant")[t % 2], "word " * 100_000 + ".") for t in range(3)]
    rows += [(78, t, "user", f"{t % 50} same.") for t in range(3000)]
    return rows


def test_faults_ties_and_nulls(spark):
    rows = fixture()
    random.Random(4).shuffle(rows)
    assert found(repair.repair_report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repaired_rows_follow_the_grammar(spark):
    import re
    rows = repair.repaired(repair.damage(spark.createDataFrame(fixture(), SCHEMA))).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.place):
        by.setdefault(r.conv_id, []).append(r)
    for conv in by.values():
        assert [r.place for r in conv] == list(range(len(conv)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[:1] for r in conv))


def test_empty_table_and_clashing_names(spark):
    assert found(repair.repair_report(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, 1, "user", "a?"), (1, 2, "assistant", "b.")]
    clash = spark.createDataFrame(rows, SCHEMA)
    for name in ("live", "fault", "copy", "head", "hash", "class", "again", "report", "place", "audit", "cost", "CONV_ID2"):
        clash = clash.withColumn(name, F.lit("x"))
    assert found(repair.repair_report(clash)) == brute(rows)


def test_registered_query_against_brute_force_and_sql(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    df = queries.QUERIES["op11_conversation_repair"](spark, SF)
    assert found(df) == brute(rows)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    told = con.sql(queries.ORACLES["op11_conversation_repair"])
    assert sorted(told.select(*df.columns).fetchall(), key=repr) == brute(rows)


def test_sql_over_faults(spark):
    """The SQL gives the contract's rows over all the odd cases, so that it is an oracle of its own."""
    con = duckdb.connect()
    rows = [r for r in fixture() if r[0] != 78]
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    names = ["conv_id", *repair.REPORT, "audit", "repaired_sha256"]
    assert sorted(con.sql(queries.ORACLES["op11_conversation_repair"]).select(*names).fetchall(), key=repr) == brute(rows)
