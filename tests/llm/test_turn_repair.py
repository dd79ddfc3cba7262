import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pytest

from pairloom.llm import turn_repair
from pairloom.llm.queries import repaired_conversations

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def _symbols(rows):
    """(initial, fault) of rows (role, text) by the contract's words."""
    seen, found, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for role, text in rows:
        solid = SOLID.findall(text)
        fault = None
        if not solid:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif solid[-1] not in ".!?":
            fault = "truncated"
        if fault:
            counts[fault] += 1
        seen.add((role, text))
        found.append((role[:1], fault))
    return found, counts


def _best(rows):
    """Dijkstra over (row, state) with (cost, edits) as the order; no dynamic programme."""
    symbols, counts = _symbols(rows)
    order = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    # A step may cost nothing, so the queue is ordered by cost, then by the edits so far.
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, state, lines = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(symbols) and state in ("", "a"):
            return cost, audit, list(lines), counts

        def push(more, letter, step, to, line):
            heapq.heappush(queue, (cost + more, audit + letter, at + step, to, lines + line))

        for role in ("user", "assistant"):
            if (state, role[0]) in order:
                push(3, "I", 0, role[0], ((role, ""),))
        if at < len(symbols):
            initial, fault = symbols[at]
            push(4, "D", 1, state, ())
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            if (state, initial) in order:
                push(more, "K", 1, initial, (rows[at],))
            for role in ("user", "assistant"):
                if (state, role[0]) in order:
                    push(3 + more, "R", 1, role[0], ((role, rows[at][1]),))


def _least_by_all(rows):
    """Every edit sequence of at most two inserts between rows."""
    symbols, _ = _symbols(rows)
    found = []
    places = [["", "I", "II"] for _ in range(len(rows) + 1)]
    edits = [["D"] if f in ("blank", "duplicate") else ["D", "K", "R"] for _, f in symbols]
    for choice in product(*places, *edits):
        gaps, own = choice[: len(rows) + 1], choice[len(rows) + 1 :]
        cost, audit, out = 0, "", ""
        for at in range(len(rows) + 1):
            cost += 3 * len(gaps[at])
            audit += gaps[at]
            out += "?" * len(gaps[at])
            if at < len(rows):
                audit += own[at]
                cut = 3 if symbols[at][1] == "truncated" else 0
                cost += {"D": 4, "K": cut, "R": 3 + cut}[own[at]]
                out += {"D": "", "K": symbols[at][0] or "x", "R": "?"}[own[at]]
        for tail in ([""] if not out else ["s" + "ua" * (len(out) // 2), "ua" * (len(out) // 2)]):
            if len(tail) == len(out) and tail != "s" and all(a == b or a == "?" and b != "s" for a, b in zip(out, tail)):
                found.append((cost, audit))
    return min(found)


def _random_rows(pick, n):
    texts = ["Yes.", "No!", "Why?", "and so", "", " \n", "then", "Fine. "]
    return [(pick.choice(["user", "assistant", "system", "tool", ""]), pick.choice(texts)) for _ in range(n)]


def _as_symbols(rows):
    place = {"s": 0, "u": 1, "a": 2}
    fault = {None: 0, "blank": 1, "duplicate": 1, "truncated": 2}
    return "".join(chr(65 + 3 * place.get(i, 3) + fault[f]) for i, f in _symbols(rows)[0])


def test_walk_equals_every_sequence_of_edits():
    pick = random.Random(1)
    for _ in range(120):
        rows = _random_rows(pick, pick.randint(0, 3))
        symbols = _as_symbols(rows)
        vector, cost = turn_repair.cost_before(symbols, turn_repair.END)
        _, audit, _ = turn_repair.walk(symbols, 0, turn_repair.END)
        assert (cost + vector[0], audit) == _least_by_all(rows), rows


def test_walk_equals_a_search():
    pick = random.Random(2)
    for at in range(400):
        rows = _random_rows(pick, at % 40)
        symbols = _as_symbols(rows)
        vector, cost = turn_repair.cost_before(symbols, turn_repair.END)
        state, audit, lines = turn_repair.walk(symbols, 0, turn_repair.END)
        least, wanted, wanted_lines, _ = _best(rows)
        assert (cost + vector[0], audit) == (least, wanted)
        assert [(role or rows[r][0], rows[r][1] if r >= 0 else "") for r, role in lines] == wanted_lines


def test_only_checkpoints_are_kept():
    symbols = _as_symbols(_random_rows(random.Random(3), 10_000))
    state, audit, lines = turn_repair.walk(symbols, 0, turn_repair.END)
    assert len(audit) >= 10_000 and state in (0, 3)
    assert turn_repair.before.cache_info().currsize < 5_000


def _expected(table):
    found = {}
    for conv in {row[0] for row in table}:
        rows = []
        for _, turn, role, text in (row for row in table if row[0] == conv):
            named = ":".join(" " if x is None else str(x) for x in (conv, turn))
            fault = zlib.crc32(named.encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)

        def place(row):
            of = "n" if conv is None else f"c{conv}"
            return hashlib.sha256(f"{of}\0{len(row[1])}:{row[1]}{row[2]}".encode()).digest()

        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, place(r)))
        said = [r[1:] for r in rows]
        cost, audit, lines, counts = _best(said)
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = zip(said, said[1:])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
        text = "\n".join(f"{role}:{text}" for role, text in lines)
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _odd_table():
    pick = random.Random(4)
    table = [(c, t, *row) for c in range(30) for t, row in enumerate(_random_rows(pick, c % 9))]
    table += [(None, t, "user", "A text.") for t in (3, None, None, 9, 3)]
    table += [(77, t, None, None) for t in range(6)] + [(78, None, "user", None), (79, 5, None, "x.")]
    table += [(80, 4, "user", "Hot. ")] * 40 + [(81, t, "assistant", "Same.") for t in range(60)]
    table += [(82, t, ("user", "assistant")[t % 2], f"No {t}" + "." * (t % 3)) for t in range(0, 400, 2)]
    return table


@pytest.mark.parametrize("segment", [1 << 14, 7])
def test_repair_of_odd_rows(spark, monkeypatch, segment):
    monkeypatch.setattr(turn_repair, "SEGMENT_ROWS", segment)
    table = _odd_table()
    schema = "conv_id long, turn long, role string, text string, part string, conv int, key string, cost string"
    frame = spark.createDataFrame([(*row, "a", 1, "b", "c") for row in table], schema).repartition(5)
    got = turn_repair.repair_damaged(frame)
    assert got.columns == ["conv_id", *COLUMNS]
    rows = got.collect()
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    assert found == _expected(table)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair_damaged(empty).collect() == []


def test_query_equals_a_search(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    got = repaired_conversations(spark, folder).collect()
    expected = _expected([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == expected
