import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from marginfold.llm import conversations as cv
from marginfold.llm.queries import op12_conversations, table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """The first fault of each (role, text) row."""
    found, seen = [], set()
    for role, text in rows:
        bare = text.strip(WHITE)
        if not bare:
            found.append(cv.BLANK)
        elif (role, text) in seen:
            found.append(cv.DUPLICATE)
        else:
            found.append(cv.NO_FAULT if bare[-1] in ".!?" else cv.TRUNCATED)
        seen.add((role, text))
    return found


def enumerated(rows):
    """Least (cost, audit) and its messages over all edits, with up to three inserts at each place."""
    kinds, best = faults(rows), None
    actions = []
    for (role, text), kind in zip(rows, kinds):
        stays = int(kind == cv.TRUNCATED)
        choices = [(3, "D", None)]
        if kind in (cv.NO_FAULT, cv.TRUNCATED):
            choices += [(stays, "K", (role, text)), (2 + stays, "R", ("user", text)), (2 + stays, "R", ("assistant", text))]
        actions.append(choices)
    inserts = [tuple(("user", "assistant")[name] for name in names) for n in range(4) for names in product((0, 1), repeat=n)]
    for chosen in product(*[part for choices in actions for part in (inserts, choices)], inserts):
        cost, audit, messages = 0, "", []
        for step in chosen:
            if step and isinstance(step[0], int):
                cost += step[0]
                audit += step[1]
                messages += [step[2]] if step[2] else []
            else:
                cost += 2 * len(step)
                audit += "I" * len(step)
                messages += [(name, "") for name in step]
        if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in messages)):
            best = min(best or (cost, audit, messages), (cost, audit, messages))
    return best


def plain(rows):
    """The same by a table of whole audits for each row and state, without dropping or emitting anything."""
    states = {cv.START: (0, "", ())}

    def closed(states):
        for sources, target in (((cv.START, cv.SYSTEM, cv.ASSISTANT), cv.USER), ((cv.USER,), cv.ASSISTANT)):
            for source in sources:
                if source in states:
                    cost, audit, messages = states[source]
                    offered = (cost + 2, audit + "I", (*messages, (cv._NAMES[target], "")))
                    states[target] = min(states.get(target, offered), offered)
        return states

    states = closed(states)
    for (role, text), kind in zip(rows, faults(rows)):
        after = {}

        def offer(state, cost, audit, messages):
            after[state] = min(after.get(state, (cost, audit, messages)), (cost, audit, messages))

        for state, (cost, audit, messages) in states.items():
            offer(state, cost + 3, audit + "D", messages)
            if kind in (cv.NO_FAULT, cv.TRUNCATED):
                stays = int(kind == cv.TRUNCATED)
                for initial, sources in {"s": [cv.START], "u": [cv.START, cv.SYSTEM, cv.ASSISTANT], "a": [cv.USER]}.items():
                    if role[:1] == initial and state in sources:
                        offer({"s": cv.SYSTEM, "u": cv.USER, "a": cv.ASSISTANT}[initial], cost + stays, audit + "K", (*messages, (role, text)))
                target = cv.ASSISTANT if state == cv.USER else cv.USER
                offer(target, cost + 2 + stays, audit + "R", (*messages, (cv._NAMES[target], text)))
        states = closed(after)
    return min(states[state] for state in (cv.START, cv.ASSISTANT) if state in states)


def expected(rows, solve=plain):
    """One result row from damaged (turn, role, text) rows in order."""
    pairs = [(role, text) for _, role, text in rows]
    kinds = faults(pairs)
    turns = {turn for turn, _, _ in rows if turn is not None}
    cost, audit, messages = solve(pairs)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[kinds.count(kind) for kind in (cv.BLANK, cv.DUPLICATE, cv.TRUNCATED)],
        sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{role}:{text}" for role, text in messages).encode()).hexdigest(),
    )


def damaged(rows):
    """Each conversation's rows after damage, in order, from (conv_id, turn, role, text)."""
    found = {}
    for conv_id, turn, role, text in rows:
        kept = found.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm:
            kept += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return {key: sorted(kept, key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())) for key, kept in found.items()}


def random_rows(rng, n):
    return [(rng.choice(["system", "user", "assistant", "assistant", "tool", " "]), rng.choice(["a.", "b!", "c", " ", "d?", "e", "f."])) for _ in range(n)]


def searched(rows):
    search = cv.Search()
    for (role, _), kind in zip(rows, faults(rows)):
        search.read(role[:1], kind)
    cost, audit = cv.least(search.ways())
    return cost, audit, cv.edited(cv.START, rows, audit)[0]


def test_the_search_equals_enumeration():
    rng = random.Random(1)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 2))
        assert searched(rows) == enumerated(rows)
        cost, audit, messages = plain(rows)
        assert (cost, audit, list(messages)) == enumerated(rows)


def test_the_search_equals_a_table_of_whole_audits():
    rng = random.Random(2)
    for _ in range(3000):
        rows = random_rows(rng, rng.randint(0, 14))
        cost, audit, messages = plain(rows)
        assert searched(rows) == (cost, audit, list(messages)), rows


def test_certain_edits_are_emitted_and_the_tree_stays_small():
    rng, search = random.Random(3), cv.Search()

    def size(edit):
        return 1 + sum(size(behind) for behind in edit.behind)

    most = 0
    for role, text in random_rows(rng, 20_000):
        search.read(role[:1], cv.NO_FAULT if text != "c" else cv.TRUNCATED)
        most = max(most, size(search.root))
    assert most < 200 and len(search.emitted) > 19_000


@pytest.mark.parametrize("block_rows", [1, 3, cv.BLOCK_ROWS])
def test_repair_equals_brute_force(spark, block_rows):
    rng, rows = random.Random(4), []
    for conv_id in [None, *range(40)]:
        # One conversation has a third of all rows.
        for place in range(150 if conv_id == 7 else rng.randint(1, 12)):
            role, text = random_rows(rng, 1)[0]
            rows.append((conv_id, rng.choice([place, place, place, None, place + 3]), rng.choice([role, role, None]), rng.choice([text, text, None])))
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*row, "clash", "x") for row in rows], "conv_id long, turn long, role string, text string, place string, audit string")
    repaired = cv.repair(cv.damage(frame.repartition(5)), block_rows=block_rows)
    found = cv.digests(repaired)
    assert found.columns == COLUMNS
    want = {(conv_id, *expected(kept)) for conv_id, kept in damaged(rows).items()}
    assert set(map(tuple, found.collect())) == want and found.count() == 41
    lines = {}
    for row in sorted(repaired.messages().collect(), key=lambda row: (row.block, row.place)):
        lines.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    hashes = {row[0]: row[-1] for row in want}
    nothing = hashlib.sha256(b"").hexdigest()
    assert {key: hashlib.sha256("\n".join(lines.get(key, [])).encode()).hexdigest() if key in lines else nothing for key in hashes} == hashes


def test_the_query_equals_brute_force(spark):
    rows = [tuple(row) for row in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = op12_conversations(spark, FOLDER)
    assert set(map(tuple, found.collect())) == {(conv_id, *expected(kept)) for conv_id, kept in damaged(rows).items()}


def test_conversations_without_rows_and_empty_tables(spark):
    dropped = next((conv_id, 0) for conv_id in range(100) if zlib.crc32(f"{conv_id}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(*dropped, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    found = cv.digests(cv.repair(cv.damage(frame))).collect()
    assert [tuple(row) for row in found] == [(dropped[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    none = cv.repair(cv.damage(frame.limit(0)))
    assert cv.digests(none).count() == none.messages().count() == 0


def test_long_texts_and_equal_rows(spark):
    long = "word " * 400_000 + "."
    rows = [(1, 1, "user", long), (1, 2, "assistant", long), *[(2, None, "user", "same.")] * 3000]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = cv.digests(cv.repair(cv.damage(frame)))
    assert set(map(tuple, found.collect())) == {(conv_id, *expected(kept)) for conv_id, kept in damaged(rows).items()}
