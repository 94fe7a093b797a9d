import hashlib
import random
import zlib

from quarry.llm import op11_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def originals(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            turn_id = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            out.setdefault(c, []).append((turn is not None, turn or 0, turn_id, role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    """{(conv_id, depth): the node's other columns} from all prefixes."""
    members = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        leaves, saved = 0, (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for q in children.get(p, []):
            more, tokens = below(q)
            leaves, saved = leaves + more, saved + tokens
        return leaves or 1, saved

    out = {}
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out[min(m), len(p)] = (min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *below(p),
                               hashlib.sha256(ends.encode()).hexdigest())
    return out


def check(spark, rows, trie, want, **options):
    got = trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    found = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    assert len(found) == len(got)
    assert found == want


def talk(seed, n, words=3, depth=6):
    rng = random.Random(seed)
    return [(c, t, rng.choice("ua"), "x" * rng.randrange(words)) for c in range(n) for t in range(rng.randrange(1, depth))]


def test_every_node_whatever_the_container_size(spark):
    rows = talk(1, 60)
    want = brute(originals(rows))
    for burst in (7, 10_000):
        check(spark, rows, op11_trie.prefix_trie, want, burst=burst)


def test_rebuilt_conversations(spark):
    rows = talk(2, 130, words=9) + talk(3, 3, depth=9) + [(-205, 1, "u", "b"), (-200, 1, "u", "a"), (-200, 2, "u", "c"), (777, None, None, None)]
    check(spark, rows, op11_trie.rebuilt_trie, brute(rebuilt(originals(rows))), burst=5)


def test_long_shared_paths_burst_at_once(spark):
    """Conversations that share many turns leave one chain of nodes, not one round for each turn."""
    path = [(t, "u", f"t{t}") for t in range(40)]
    rows = [(c, *x) for c in range(9) for x in path[:40 - c % 2 * 3]] + [(c, 50 + c, "a", "own") for c in range(0, 9, 2)] + [
        (c, 60, "a", f"end {c}") for c in range(9)]
    check(spark, rows, op11_trie.prefix_trie, brute(originals(rows)), burst=4)


def test_copies_are_one_class(spark):
    rows = [(c, t, "u", f"same {t}") for c in range(300) for t in range(3)]
    old, op11_trie.PIECE = op11_trie.PIECE, 16
    try:
        check(spark, rows, op11_trie.prefix_trie, brute(originals(rows)), burst=2)
    finally:
        op11_trie.PIECE = old


def test_edge_rows(spark):
    rows = [(None, 1, "u", "no id"), (1, None, "u", "first"), (1, None, "u", "first"), (1, 1, None, None), (1, 1, "", "tie"),
            (2, 1, "1:", "a"), (3, 1, "1", ":a"), (4, 3, "u", "ż😀" * 20_000), (4, 3, "u", "ż😀" * 20_000), (5, 9, "u", "")]
    check(spark, rows, op11_trie.prefix_trie, brute(originals(rows)), burst=2)
    check(spark, rows, op11_trie.rebuilt_trie, brute(rebuilt(originals(rows))))
    extra = spark.createDataFrame([(*r, "k", 7) for r in rows], SCHEMA + ", key string, depth int")
    assert len(op11_trie.rebuilt_trie(extra).collect()) == len(brute(rebuilt(originals(rows))))
    assert op11_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []
