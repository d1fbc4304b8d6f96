"""The trie against a plain one, on made-up turns and on long conversations."""

import hashlib
import random
import zlib

from paneflow.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain(rows):
    """Nodes as a sorted list, straight from the definition."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in own.items():
        turns.sort(key=lambda t: (*t[:3], hashlib.md5(t[3].encode()).hexdigest()))
        own[conv] = [t[2:] for t in turns]
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        first = conv - int(conv / 20) * 20
        rebuilt[conv] = tuple(own.get(conv - first, [])[:h] + turns[h:])
    nodes = {}
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(conv)
    children = {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        out = [node]
        for at in out:
            out.extend(children.get(at, []))
        return out

    out = []
    for node, members in nodes.items():
        subtree = below(node)
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1].encode().split()) for n in subtree if n)
        ends = ",".join(map(str, sorted(c for c in members if rebuilt[c] == node)))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
            len(children.get(node, [])), sum(n not in children for n in subtree), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    got = trie.rebuilt_trie(frame)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                           "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_copies_prefixes_ties_and_nulls(spark):
    rng = random.Random(5)
    said = ["yes", "no  thanks", "", "a　b c\n", None, "long " * 30]
    rows = []
    for conv in range(130):
        for turn in range(rng.randrange(6)):
            rows.append((conv, turn, rng.choice(["user", "bot"]), rng.choice(said[:2])))
    rows += [(200 + i, t, "user", "the same") for i in range(40) for t in range(3 + i % 2)]
    # Null turns come first, ties go by role, rows repeat, ids are negative or missing.
    rows += [(301, 0, "b", "x"), (301, None, None, "y z"), (301, 0, "a", None), (301, 0, "a", None),
             (-7, 1, "user", "yes"), (-27, 2, "user", "yes"), (None, 0, "user", "yes")]
    rows += [(400 + i, t, rng.choice([None, "", "u"]), rng.choice(said)) for i in range(40) for t in range(4)]
    check(spark, rows)


def test_conversations_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 4)
    monkeypatch.setattr(trie, "ENDS_PER_ROW", 3)
    same = [(c, t, "u", f"w {t}") for c in (500, 501, 502, 503, 504, 505, 506) for t in range(30)]
    longer = [(c, t, "u", f"w {t % 20}") for c in (520, 521) for t in range(41)]
    check(spark, same + longer)


def test_empty_table(spark):
    assert trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
