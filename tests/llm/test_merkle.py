import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from segrec.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, seq string, pos int, digest string, n int, key string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def fold(nodes, width):
    """Levels of a tree as lists, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + width])) for k in range(0, len(levels[-1]), width)])
    return levels


def proof(levels, place, width):
    found = []
    for level in levels[:-1]:
        start = place // width * width
        found.append(("".join(level[start:place]), "".join(level[place + 1:start + width])))
        place //= width
    return found


def climb(digest, path):
    for before, after in path:
        digest = sha(before + digest + after)
    return digest


def brute(rows, tampered, width=2):
    """(doc_id, leaf, subroot, root, proof, folded root) per row; rows are (doc_id, source, lang, n_chars, text)."""
    key = lambda r: (r[2] is not None, (r[2] or "").encode())
    groups = []
    for _, members in groupby(sorted(rows, key=key), key=key):
        groups.append(sorted(members, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))))
    trees = [fold([leaf(r) for r in g], width) for g in groups]
    top = fold([t[-1][0] for t in trees], width) if trees else []
    out = []
    for k, (g, t) in enumerate(zip(groups, trees, strict=True)):
        for place, r in enumerate(g):
            path = proof(t, place, width) + proof(top, k, width)
            shown = leaf((*r[:3], None if r[3] is None else r[3] + 1, r[4])) if tampered(r[0]) else leaf(r)
            out.append((r[0], leaf(r), t[-1][0], top[-1][0], sha("".join(b + a for b, a in path)), climb(shown, path)))
    return out


def query(rows, width, block_levels):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = merkle.leaves(rows, FIELDS, "doc_id", "lang", changed={"n_chars": F.col("n_chars") + 1}, when=tampered)
    return merkle.build(leaves, width, block_levels).rows()


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def documents():
    rows = [(i, f"t{i} é", ["en", "fr", "日", None, "en"][i % 5], f"s{i % 3}" if i % 4 else None, i if i % 6 else None) for i in range(60)]
    rows += [(None, "x", "en", "a", 1), (None, None, None, None, None), (7, "other", "en", "s", 2), (100, "", "", "", 0), (101, "y" * 30000, "zz", "s", 30000)]
    return rows + [(200, "copy", "en", "s", 4)] * 40


@pytest.mark.parametrize(("width", "block_levels"), [(2, 10), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2), (5, 1)])
def test_manifest_matches_a_plain_tree(frame, width, block_levels):
    docs = documents()
    found = query(frame([(*d, "=x", 1, "d", 2, "k") for d in docs], SCHEMA), width, block_levels)
    found = found.withColumn("folded", merkle.folded(F.coalesce("altered", "leaf"), F.col("path"))).collect()
    expect = brute([(i, s, lang, n, t) for i, t, lang, s, n in docs], is_tampered, width)
    got = [(r["key"], r["leaf"], r["subroot"], r["root"], sha("".join(x["before"] + x["after"] for x in r["path"])),
            r["version_root"] or climb(r["leaf"], [(x["before"], x["after"]) for x in r["path"]])) for r in found]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted(expect, key=order)
    for r in found:
        assert (r["altered"] is not None) == is_tampered(r["key"])
        if r["altered"] is not None:
            assert r["version_root"] == r["folded"] and len(r["copied"]) == len(r["path"])
            assert (r["copied"] or [r["altered"]])[-1] == r["version_root"]
        else:
            assert r["folded"] == r["root"] and r["copied"] is None


def test_one_row_and_empty_table(frame):
    (only,) = query(frame([(1, "a", "en", "s", 1, "", 0, "", 0, "")], SCHEMA), 2, 10).collect()
    assert only["leaf"] == only["subroot"] == only["root"] and only["path"] == []
    assert query(frame([], SCHEMA), 2, 10).collect() == []


@pytest.mark.parametrize(("n", "levels", "width"), [(1, 0, 2), (1, 3, 2), (5, 3, 2), (8, 3, 2), (7, 2, 3)])
def test_versions_share_untouched_nodes(n, levels, width):
    leaves = [sha(str(k)) for k in range(n)]
    tree = merkle.PersistentTree(leaves, levels, width)
    before, first = len(tree.digests), tree.root
    versions = {}
    for k in range(n):
        size = len(tree.digests)
        versions[k] = tree.changed(first, k, "x")
        assert len(tree.digests) - size == levels + 1  # the leaf and its ancestors
    def walk(node):
        yield node
        for c in tree.children[node]:
            yield from walk(c)

    def plain(nodes):
        for _ in range(levels):
            nodes = [sha("".join(nodes[k:k + width])) for k in range(0, len(nodes), width)]
        return nodes[0]

    assert tree.digests[first] == plain(leaves)
    for k, root in versions.items():
        assert tree.digests[root] == plain([*leaves[:k], "x", *leaves[k + 1:]])
        assert sum(node >= before for node in walk(root)) == levels + 1
    both = tree.changed(versions[0], n - 1, "y")
    assert tree.digests[both] == plain([*(["x"] if n > 1 else []), *leaves[1:-1], "y"])
    assert tree.digests[versions[0]] == plain(["x", *leaves[1:]])
