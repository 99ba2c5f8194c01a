import random
import re
import zlib
from hashlib import sha256

import __spark_entry__ as registry
from keepsight.llm.order import ranked, running_sums
from keepsight.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def plain_turns(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(t[2], t[3]) for t in sorted(ts)] for c, ts in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


class Node:
    def __init__(self):
        self.below, self.members, self.ends, self.words = {}, [], [], 0


def expected(convs):
    """Plain trie, walked turn by turn."""
    root = Node()
    for c in sorted(convs):
        node = root
        node.members.append(c)
        for role, text in convs[c]:
            node = node.below.setdefault((role, text), Node())
            node.members.append(c)
            node.words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        node.ends.append(c)
    order = [(root, 0, None)]
    for node, depth, _ in order:
        order.extend((below, depth + 1, node) for below in node.below.values())
    sums = {}
    for node, _, _ in reversed(order):
        leaves, saved = int(not node.below), (len(node.members) - 1) * node.words
        for below in node.below.values():
            leaves, saved = leaves + sums[id(below)][0], saved + sums[id(below)][1]
        sums[id(node)] = (leaves, saved)
    out = []
    for node, depth, parent in order if convs else []:
        ends = sha256(",".join(map(str, node.ends)).encode()).hexdigest()
        above = parent.members[0] if parent else None
        counts = (len(node.members), len(node.below), *sums[id(node)])
        out.append((node.members[0], depth, above, *counts, ends))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def many(seed=1):
    """Conversations over few distinct turns, so that they share prefixes of all lengths."""
    rng = random.Random(seed)
    rows = []
    for c in range(250):
        start = "common" if c % 3 == 0 else f"s{rng.randrange(4)}"
        turns = [start] + [f"t{rng.randrange(3)} and words" for _ in range(rng.randrange(12))]
        rows += [(c, i, "user" if i % 2 else None, t) for i, t in enumerate(turns)]
    copies = [(500 + c, i, "user", f"copied {i}") for c in range(90) for i in range(5)]
    return rows + copies


def test_trie_equals_the_plain_one(spark):
    rows = many()
    assert result(conversation_trie(frame(spark, rows))) == expected(plain_turns(rows))


def test_rebuilt_trie_equals_the_plain_one(spark):
    rows = [r for r in many(2) if r[0] not in (20, 40)] + [(-7, 0, "user", "a"), (-20, 5, "user", "b")]
    got = result(conversation_trie(frame(spark, rows), rebuilt=True))
    assert got == expected(plain_rebuilt(plain_turns(rows)))
    assert any(depth == 0 and ends != sha256().hexdigest() for _, depth, *_, ends in got)


def test_nulls_repeated_rows_and_a_long_conversation(spark):
    rows = [
        (None, 1, "user", "no conversation"),
        (1, None, None, None),
        (1, 1, "user", ""),
        (2, None, "", ""),
        (2, 1, "user", None),
        (2, 1, "user", None),
        (3, 0, "a:", "b"),
        (4, 0, "a", ":b"),
        (5, 0, "user", "long " * 30_000),
        *[(6, i, "user", f"turn {i % 7}") for i in range(2500)],
        *[(7, i, "user", f"turn {i % 7}") for i in range(2499)],
    ]
    assert result(conversation_trie(frame(spark, rows))) == expected(plain_turns(rows))


def test_chains_that_hang_from_one_another(spark):
    """Conversation i leaves the way of i - 1 one turn later, so chains nest as deep as they are many."""
    rows = [(i, d, "user", "left" if d == 2 * i else "on") for i in range(40) for d in range(2 * i + 1)]
    rows = [(-i, d, r, t) for i, d, r, t in rows]
    assert result(conversation_trie(frame(spark, rows))) == expected(plain_turns(rows))


def test_no_conversations(spark):
    assert result(conversation_trie(frame(spark, []), rebuilt=True)) == []


def test_query_equals_the_plain_trie(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(registry.queries()["op13_prefix_trie"](spark, folder))
    assert got == expected(plain_rebuilt(plain_turns(rows)))


def test_ranks_of_a_group_that_holds_most_rows(spark, table):
    rng = random.Random(3)
    rows = [("hot" if i % 4 else None, rng.randrange(30), i) for i in range(2000)]
    got = ranked(table(rows, "g string, v int, i int").repartition(7), "g", ["v"], "ranks").collect()
    for group in ("hot", None):
        mine = sorted((r for r in got if r.g == group), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        assert [r.v for r in mine] == sorted(r.v for r in mine)
        assert {r.size for r in mine} == {len(mine)}


def test_running_sums_over_chunks(spark, table):
    rows = [(g, i, i % 5) for g in ("a", "b") for i in range(3000)]
    df = table(rows, "g string, i long, v long").repartition(5)
    forth = {(r.g, r.i): r.v for r in running_sums(df, "g", "i", ["v"], own=False).collect()}
    back = {(r.g, r.i): r.v for r in running_sums(df, "g", "i", ["v"], backwards=True).collect()}
    total = sum(i % 5 for i in range(3000))
    assert len(forth) == len(back) == 6000 and forth["a", 0] == 0
    assert all(forth[k] + back[k] == total for k in forth)
