"""Role repair, SimHash classes and Merkle proofs against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from cases import SCHEMA, empty_docs, hard_docs, hard_rows
from lotflow.llm import merkle, role_repair, simhash

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NAMES = {"u": "user", "a": "assistant"}


def least_repair(rows):
    """Counts, cost, audit and digest of turns in order, by a plain search over the last role."""
    seen, faults, illegal = set(), [], 0
    for n, (_, role, text) in enumerate(rows):
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "" if marks[-1] in ".!?" else "truncated")
        seen.add((role, text))
        illegal += n > 0 and rows[n - 1][1][:1] + role[:1] not in ("su", "ua", "au")

    def put(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def filled(ways):
        for letter in "uaua":
            for state, (cost, audit, out) in list(ways.items()):
                if (state, letter) in NEXT:
                    put(ways, letter, (cost + 2, audit + "I", (*out, f"{NAMES[letter]}:")))
        return ways

    ways = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, out) in filled(ways).items():
            put(after, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            if (state, role[:1]) in NEXT:
                put(after, role[0], (cost, audit + "K", (*out, f"{role}:{text}")))
            for letter in "ua":
                if (state, letter) in NEXT:
                    put(after, letter, (cost + 2, audit + "R", (*out, f"{NAMES[letter]}:{text}")))
        ways = after
    cost, audit, out = min(way for state, way in filled(ways).items() if state in ("", "a"))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain_repairs(rows):
    """Conversations after damage, each repaired; rows are (conv_id, turn, role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        found.setdefault(conv, []).extend([(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    order = lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())
    return sorted(((conv, *least_repair(sorted(turns, key=order))) for conv, turns in found.items()), key=str)


TURNS = "conv_id long, turn long, role string, text string, gone_by int, at string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], TURNS)


def chats(seed, n=120):
    draw = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "user2", "é"]
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n\t", None, "x. \t", "日本。", "end?\x85", "l" * 3000 + "."]
    rows = []
    for conv in range(n):
        first = draw.choice([0, 3, -2])
        rows += [(conv, first + t + draw.choice([0, 0, 0, 2]), draw.choice(roles), draw.choice(texts) if draw.random() < 0.6 else f"Turn {t}.") for t in range(draw.randrange(1, 15))]
    return rows + [(None, 1, "user", "no id."), (None, None, "assistant", "nor turn."), (None, None, None, None), (900, None, "user", "a.")] + rows[:40]


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_repairs(spark, monkeypatch, chunk):
    rows = chats(chunk)
    monkeypatch.setattr(role_repair, "CHUNK", chunk)  # for the parse below; workers keep their own
    for seed in range(60):
        turns = [row[1:] for row in chats(seed, 1)[:12]]
        turns = [(turn, role or "", text or "") for turn, role, text in turns]
        turns.sort(key=lambda row: (row[0] is not None, row[0] or 0))
        talk, seen = role_repair.Conversation(1), set()
        for turn, role, text in turns:
            talk.add(turn, role, text, (role, text) in seen)
            seen.add((role, text))
        assert talk.row()[1:9] == least_repair(turns)
    got = role_repair.repairs(role_repair.damaged(conversations(spark, rows))).drop("system")
    assert sorted(map(tuple, got.collect()), key=str) == plain_repairs(rows)


def test_long_conversation_and_turns(spark):
    draw = random.Random(5)
    rows = [(1, n, draw.choice(["user", "assistant", "system"]), f"Turn {n}{draw.choice('.!?,')}") for n in range(3000)] + chats(9, 20)
    broken = role_repair.damaged(conversations(spark, rows))
    got = sorted(map(tuple, role_repair.repairs(broken).drop("system").collect()), key=str)
    assert got == plain_repairs(rows)
    turns = {}
    for row in role_repair.repaired_turns(broken).orderBy("conv_id", "place").collect():
        turns.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    assert {row[0]: row[8] for row in got} == {row[0]: hashlib.sha256("\n".join(turns.get(row[0], [])).encode()).hexdigest() for row in got}


def test_repairs_of_nothing(spark):
    assert role_repair.repairs(role_repair.damaged(conversations(spark, []))).collect() == []
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    [row] = role_repair.repairs(role_repair.damaged(conversations(spark, [(gone, 0, "user", "a.")]))).collect()
    assert tuple(row)[1:9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[n : n + 4]).encode(), seed=42).intdigest() for n in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_classes(values, distance=4):
    """Least index of each value's class, by all pairs."""
    top = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    while True:
        least = np.where(near, top[None, :], len(values)).min(axis=1)
        if (least == top).all():
            return top
        top = least


def test_fingerprints_and_classes(spark):
    draw = random.Random(3)
    base = [" ".join(draw.choice("abcdefgh") * 3 for _ in range(60)) for _ in range(20)]
    texts = [t for b in base for t in (b, b.upper(), b + " tail", b.replace(" ", "\n", 3))] + ["one two three", "ONE two three", "É é"]
    rows = hard_rows(texts)
    got = sorted(map(tuple, simhash.near_duplicates(hard_docs(spark, texts)).collect()), key=str)
    values = np.array([plain_fingerprint(row[1]) for row in rows], dtype=np.uint64)
    classes = plain_classes(values)
    least = {c: min(row[0] for row, d in zip(rows, classes) if d == c and row[0] is not None) for c in set(classes) if any(row[0] is not None for row, d in zip(rows, classes) if d == c)}
    assert got == sorted(((row[0], f"{value:016x}", least.get(c)) for row, value, c in zip(rows, values.tolist(), classes)), key=str)
    assert simhash.near_duplicates(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("bucket", [4096, 8])
def test_ties_join_all_that_is_near(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)  # 8: dense buckets are cut again, down to the last block
    draw = random.Random(bucket)
    values = {draw.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for _ in range(4):  # dense clouds, chains, and values that share half of their bits
        centre = draw.getrandbits(64)
        values |= {centre ^ sum(1 << bit for bit in draw.sample(range(64), draw.randrange(7))) for _ in range(60)}
        values |= {centre & 0xFFFFFFFF | draw.getrandbits(32) << 32 for _ in range(60)}
    values = np.array(sorted(values), dtype=np.uint64)
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    edges = simhash.linked(fps).collect()
    place = {int(v): n for n, v in enumerate(values.view(np.int64))}
    top = list(range(len(values)))

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in edges:
        assert int(values[place[a]] ^ values[place[b]]).bit_count() <= 4
        p, q = sorted((find(place[a]), find(place[b])))
        top[q] = p
    assert [find(n) for n in range(len(values))] == plain_classes(values).tolist()


def plain_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) with leaf, subroot, root, proof digest, folded root, verified."""
    hashed = lambda text: hashlib.sha256(text.encode()).hexdigest()
    leaf_of = lambda row: hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        proofs, places = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for n, place in enumerate(places):
                run = place // 3 * 3
                proofs[n].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 3])))
                places[n] = place // 3
            nodes = [hashed("".join(nodes[n : n + 3])) for n in range(0, len(nodes), 3)]
        return nodes[0] if nodes else None, proofs

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    leaves = [sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in groups[name]), key=lambda leaf: leaf[:3]) for name in names]
    trees = [tree([leaf[2] for leaf in group]) for group in leaves]
    root, top = tree([subroot for subroot, _ in trees])
    out = []
    for group, (subroot, proofs), above in zip(leaves, trees, top):
        for (_, _, leaf, row), proof in zip(group, proofs):
            number, text = row[0], row[4]
            if number is not None and text is not None and zlib.crc32(str(number).encode()) % 2 == 0:
                text = text.replace("\n", "")
            value = leaf_of((*row[:4], text))
            for left, right in proof + above:
                value = hashed(left + value + right)
            out.append((number, leaf, subroot, root, hashed("".join(a + b for a, b in proof + above)), value, value == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("sources", [1, 2, 30])
def test_merkle_proofs(spark, sources):
    draw = random.Random(sources)
    hard = [(row[0], None if sources == 1 else row[3], row[2], row[4], row[1]) for row in hard_rows()]
    name = lambda: None if sources == 1 else draw.choice([None, "", "s", "é", "\U0001f600", "￿", *(f"s{n}" for n in range(sources))])
    rows = hard + [(draw.choice([n, -n, 7]), name(), "en", n, f"line {n}\nmore") for n in range(260)]
    docs = spark.createDataFrame([(row[0], row[4], row[2], row[1], row[3], 0.0, 0, 1) for row in rows], SCHEMA)
    got = merkle.tamper_check(docs.withColumnsRenamed({"rep": "tree", "size": "n"}))
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows)


def test_merkle_of_nothing_and_one(spark):
    assert merkle.tamper_check(empty_docs(spark)).collect() == []
    [row] = merkle.manifest(hard_docs(spark).where("doc_id = 3").limit(1)).collect()
    assert row.leaf == row.subroot == row.root and row.proof == []
