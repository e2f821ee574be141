"""Conversation repair against brute force, and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from marquee.llm import conversation_repair, queries

LEGAL = re.compile(r"(s?(ua)+)?")
COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    """Rows of one conversation in order, with the first fault of each."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, turns) by plain comparison of (cost, audit) from each row and roles so far."""

    @lru_cache(maxsize=None)
    def best(i, made):
        options = []
        if i == len(rows) and made in ("", "a"):
            options.append((0, "", ()))
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}[made]
        name = {"u": "user", "a": "assistant"}[nexts]
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, turns = best(i + 1, made)
            options.append((cost + 2, "D" + audit, turns))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] == nexts or (made == "" and role[:1] == "s"):
                    cost, audit, turns = best(i + 1, role[:1])
                    options.append((cost + more, "K" + audit, ((role, text), *turns)))
                cost, audit, turns = best(i + 1, nexts)
                options.append((cost + more + 1, "R" + audit, ((name, text), *turns)))
        options += inserted(i, made, 2)
        return min(options)

    @lru_cache(maxsize=None)
    def inserted(i, made, left):
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}[made]
        name = {"u": "user", "a": "assistant"}[nexts]
        options = []
        if left:
            options = list(inserted(i, nexts, left - 1))
            if i == len(rows) and nexts == "a":
                options.append((0, "", ()))
            if i < len(rows):
                role, text, fault = rows[i]
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    after = {"": "u", "s": "u", "u": "a", "a": "u"}[nexts]
                    if role[:1] == after:
                        cost, audit, turns = best(i + 1, after)
                        options.append((cost + more, "K" + audit, ((role, text), *turns)))
                    cost, audit, turns = best(i + 1, after)
                    options.append((cost + more + 1, "R" + audit, (({"u": "user", "a": "assistant"}[after], text), *turns)))
                cost, audit, turns = best(i + 1, nexts)
                options.append((cost + 2, "D" + audit, turns))
        return [(cost + 5, "I" + audit, ((name, ""), *turns)) for cost, audit, turns in options]

    return best(0, "")


def sha(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def brute_query(rows):
    broken, out = brute_damage(rows), []
    for conv in {r[0] for r in rows}:
        mine = [r for r in broken if r[0] == conv]
        judged = faults(mine)
        turns = [t for _, t, _, _ in mine if t is not None]
        cost, audit, kept = cheapest(tuple(judged))
        initials = [r[:1] for r, _, _ in judged]
        assert LEGAL.fullmatch("".join(r[:1] for r, _ in kept))
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                *(sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")),
                sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                cost,
                audit,
                sha(kept),
            )
        )
    return sorted(out, key=repr)


def conversations(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]) if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
            text = rng.choice(["Yes.", "no", "Why? ", " \t", "", "So it is!\n", f"Turn {turn}.", f"turn {conv}"])
            rows.append((conv, turn + (turn > 3) * rng.randint(0, 2), role, text))
    return rows


AWKWARD = [
    (None, 0, "user", "Hello."),
    (None, None, None, "No turn."),
    (900, None, "user", None),
    (900, None, "assistant", "x."),
    (900, 1, None, None),
    (901, 5, "", "no role."),
    (901, 5, "User", "capital."),
    (902, 1, "user", "Same."),
    (902, 1, "user", "Same."),
    (902, 2, "user", "Same."),
    (903, 1, "user", "long. " * 60_000),
    (903, 2, "assistant", "wörd \U0001f600 " * 30_000 + " "),
    (904, -3, "assistant", "First?"),
]


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_repair_equals_brute_force(spark, tmp_path, partitions):
    rng = random.Random(partitions)
    rows = conversations(rng, 120, 9) + conversations(rng, 3, 40) + AWKWARD
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, COLUMNS).withColumn("_conv", F.lit(1)).withColumn("chunk", F.lit("x")).repartition(3)
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(got, key=repr) == brute_query(rows)


def test_long_conversation_spreads_over_chunks(spark):
    """One conversation holds most rows; a third of them are equal."""
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Turn {t}.", f"Turn {t}.", f"turn {t}", ""])) for t in range(900)]
    rows += [(1, 450, "user", "Again and again.")] * 500 + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    repair = conversation_repair.repair_conversations(spark.createDataFrame(rows, COLUMNS).repartition(6))
    assert repair.chunks.filter("_conv = 1").count() >= 5
    summary = {r.conv_id: r for r in repair.summary.collect()}
    digests = {r.conv_id: r.sha256 for r in repair.digests().collect()}
    for conv in (1, 2):
        judged = faults([r for r in rows if r[0] == conv])
        marks = [{"blank": "b", "duplicate": "d", "truncated": "t", "": "."}[f] for _, _, f in judged]
        cost, audit = conversation_repair.whole_audit([r[:1] for r, _, _ in judged], marks)
        kept = list(conversation_repair.edited(0, audit, [r for r, _, _ in judged], [t for _, t, _ in judged]))
        assert (summary[conv].cost, summary[conv].audit, digests[conv]) == (cost, audit, sha(kept))
    placed = repair.rows().filter("conv_id = 1").orderBy("place").collect()
    assert [r.place for r in placed] == list(range(len(placed)))
    assert LEGAL.fullmatch("".join(r.role[:1] for r in placed))


@pytest.mark.parametrize("seed", range(6))
def test_chained_chunks_equal_one_chunk(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n = rng.randint(1, 14)
        initials, marks = [rng.choice("suat") for _ in range(n)], [rng.choice("bdt...") for _ in range(n)]
        rows = tuple((i, str(k), {"b": "blank", "d": "duplicate", "t": "truncated", ".": ""}[m]) for k, (i, m) in enumerate(zip(initials, marks, strict=True)))
        want = cheapest(rows)[:2]
        assert conversation_repair.whole_audit(initials, marks) == want
        chain, at, number = conversation_repair.Chain(), 0, 0
        while at < n:
            size = rng.randint(1, 5)
            chunk = conversation_repair.Chunk(initials[at : at + size], marks[at : at + size], initials[at : at + size], [""] * size)
            chain.add(conversation_repair._chunk_row(1, number, chunk, whole=False))
            at, number = at + size, number + 1
        choices = list(chain.choices())
        assert (choices[-1]["cost"], choices[-1]["audit"]) == want
        assert "".join(c["edits"] for c in choices) == want[1]


def test_least_edits_by_all_audits():
    """Every sequence of edits of up to three rows is tried."""
    for n in range(4):
        for initials in itertools.product("suat", repeat=n):
            for marks in itertools.product("bt.", repeat=n):
                best = min((try_audit(initials, marks, a) for k in range(n + 3) for a in itertools.product("DIKR", repeat=k)), default=None)
                assert conversation_repair.whole_audit(list(initials), list(marks)) == best, (initials, marks)


def try_audit(initials, marks, audit):
    """(cost, audit), with an infinite cost where the edits are not allowed."""
    cost, row, made = 0, 0, ""
    for letter in audit:
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}[made[-1:]]
        if letter == "I":
            cost, made = cost + 5, made + nexts
            continue
        if row == len(initials):
            return float("inf"), ""
        initial, mark = initials[row], marks[row]
        row += 1
        if letter == "D":
            cost += 2
            continue
        if mark in "bd":
            return float("inf"), ""
        cost += 5 * (mark == "t") + (letter == "R")
        if letter == "R":
            made += nexts
        elif initial == nexts or (not made and initial == "s"):
            made += initial
        else:
            return float("inf"), ""
    if row < len(initials) or not LEGAL.fullmatch(made):
        return float("inf"), ""
    return cost, "".join(audit)


def test_repair_of_nothing(spark):
    repair = conversation_repair.repair_conversations(spark.createDataFrame([], COLUMNS))
    assert repair.summary.count() == repair.rows().count() == repair.digests().count() == 0
