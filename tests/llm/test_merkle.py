import zlib
from hashlib import sha256

import pytest

import __spark_entry__ as registry
from keepsight.llm.merkle import FIELDS, audit, merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, group int, path string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """The last node, and for each node its (left, right) sibling texts upwards."""
    ways = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, covered = [], []
        for first in range(0, len(nodes), 8):
            run = nodes[first : first + 8]
            for k, members in enumerate(under[first : first + 8]):
                for i in members:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(digest("".join(run)))
            covered.append(sum(under[first : first + 8], []))
        nodes, under = above, covered
    return nodes[0], ways


def expected(rows):
    """Plain version over (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    subs, ways = {}, {}
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        subs[name], ways[name] = climb([x[2] for x in groups[name]])
    root, tops = climb([subs[n] for n in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        for (_, _, leaf, row), way in zip(groups[name], ways[name], strict=True):
            way = way + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf_of((*row[:4], lower(row[4]))) if tampered else leaf
            for left, right in way:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in way))
            out.append((row[0], leaf, subs[name], root, proof, node, node == root))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows, parts=3):
    full = [(r[0], r[4], r[2], r[1], r[3], "x", 1, "y") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


ODD = [
    (None, None, None, None, None),
    (None, "s", None, 1, "No Id"),
    (3, "s", "", 2, ""),
    (4, None, "", None, "LONG " * 20_000),
    (4, "é", "dé", -1, "Ünïcode \U0001f642 A"),
    (5, "s", "dé", 1, "Same Row"),
    (5, "s", "dé", 1, "Same Row"),
    (5, "s", "dé", 1, "Other text of the id"),
]


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [1, 8, 65], [3] * 11, [600]])
def test_equals_the_plain_tree(spark, sizes):
    rows = [(i, "s", f"l{g}", i, f"Text {i} of {g}") for g, n in enumerate(sizes) for i in range(n)]
    got = result(audit(merkle_manifest(frame(spark, rows))))
    assert got == expected(rows)
    tampered = [r[0] for r in got if not r[6]]
    assert all(zlib.crc32(str(i).encode()) % 3 == 0 for i in tampered)


def test_nulls_long_texts_and_repeated_rows(spark):
    assert result(audit(merkle_manifest(frame(spark, ODD)))) == expected(ODD)


def test_a_third_of_all_rows_are_one_row(spark):
    rows = [(7, "s", "en", 1, "Copy")] * 150 + [(i, "s", "en", 1, f"t{i}") for i in range(300)]
    assert result(audit(merkle_manifest(frame(spark, rows, 5)))) == expected(rows)


def test_no_documents(spark):
    assert result(audit(merkle_manifest(frame(spark, [])))) == []


def test_path_of_a_leaf_leads_to_the_root(spark):
    rows = [(i, None, "en" if i % 3 else None, i, f"t{i}") for i in range(80)]
    for row in merkle_manifest(frame(spark, rows)).collect():
        node = row.leaf
        for step in row.path:
            node = digest(step.left + node + step.right)
        assert node == row.root


def test_query_equals_the_plain_tree(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*FIELDS).collect()]
    assert result(registry.queries()["op12_merkle_manifest"](spark, folder)) == expected(rows)
