"""Collocations, quality rules and conversation repair against brute force, on awkward and empty tables."""

import collections
import hashlib
import itertools
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from quotelake.llm import collocations, conversation_repair, quality_rules  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, kept string, n_words string, __rules int, score int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- collocations


def brute_collocations(rows, top=collocations.TOP):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang][" ".join(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if a >= 100 and 2 <= len(p.split(" ")) <= 5}
        found = []
        for p, a in cands.items():
            if any(len(q.split(" ")) > len(p.split(" ")) and fq >= a and f" {p} " in f" {q} " for q, fq in cands.items()):
                continue
            ws = p.split(" ")
            best = min(
                (1000 * a * n[lang] // (c[" ".join(ws[:k])] * c[" ".join(ws[k:])]), k) for k in range(1, len(ws))
            )
            k = best[1]
            found.append((lang, p, a, c[" ".join(ws[:k])], c[" ".join(ws[k:])], n[lang], best[0]))
        found.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], rank, *r[1:]) for rank, r in enumerate(found[:top], 1)]
    return sorted(out)


def _corpus():
    rnd = random.Random(7)
    vocab = ["alpha", "beta", "gamma", "delta", "Eps", "zeta", "eta", "théta", "iota", "kappa"]
    rows = []
    for i in range(400):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 40))]
        text = " ".join(words)
        if i % 3 == 0:
            text += ". Shared passage of several words, said again\nShared passage of several words"
        rows.append((i, text, None if i % 7 == 0 else ("en" if i % 2 else "de")))
    rows += [(None, None, "en"), (1, "", "en"), (2, "   \t ", None), (3, "one; two: three!", "en")] * 2
    return rows


def test_collocations_equal_brute_force(spark):
    rows = _corpus()
    df = spark.createDataFrame([(*r, "src", "x", "y", 1, 2) for r in rows], DOCS).repartition(5)
    got = collocations.collocations(df, top=50).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations([(r[1], r[2]) for r in rows], top=50)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_hash_collisions_merge_no_counts(spark, monkeypatch):
    """With four hashes in all, every filter lets everything pass; the counts go by words."""
    monkeypatch.setattr(collocations, "_mixed", lambda values: values & np.uint64(3))
    rows = _corpus()
    df = spark.createDataFrame([(*r, "src", "x", "y", 1, 2) for r in rows], DOCS).repartition(5)
    got = collocations.collocations(df, top=50).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations([(r[1], r[2]) for r in rows], top=50)


def test_levels_count_within_blocks(spark, monkeypatch):
    """A level hands on one row for each hash of a block, not one for each place, and a filter loses no hash."""
    monkeypatch.setattr(collocations, "MIN_COUNT", 1)
    df = spark.createDataFrame([(i, "one two three four five. " * 50 + f"x{i}", "en") for i in range(300)], "doc_id long, text string, lang string")
    blocks = collocations._packed(collocations._chunks(df.coalesce(1)).coalesce(1)).localCheckpoint()
    assert blocks.count() == 1
    level = collocations._hash_level(blocks, 1, None).localCheckpoint()
    assert level.count() == 305
    passes = collocations._filter(level)
    block = collocations._Block(blocks.first().asDict())
    assert block.known(1, passes).all()
    plan = level.sparkSession._jvm.PythonSQLUtils.explainString(
        collocations._hash_level(blocks, 2, None)._jdf.queryExecution(), "simple"
    )
    assert "Generate" not in plan and "Join" not in plan


def test_chunks_own_every_word_once(spark):
    rows = _corpus()
    df = spark.createDataFrame([(*r, "src", "x", "y", 1, 2) for r in rows], DOCS)
    dictionary = collocations.chunk_dictionary(df).collect()
    owned = collections.Counter()
    for r in dictionary:
        owned[r["lang"]] += r["own"] * r["freq"]
        assert 1 <= r["own"] <= len(r["words"]) <= r["own"] + collocations.WINDOW
    expected = collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            expected[lang or "und"] += len([x for x in re.split(r"[\x20\x09]+", piece) if x])
    assert owned == +expected


def test_exact_score_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**12, 10**12 - 1, 999999999999, 1000000000001)], "a long, n long, l long, r long")
    got = collocations.with_exact_score(df).first()["score"]
    assert got == (10**12 * (10**12 - 1) * 1000) // (999999999999 * 1000000000001)


# ---------------------------------------------------------------- quality rules


def brute_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = len(lines) - len(set(lines))
    grams = collections.Counter(" ".join(w[j:j + 3]) for j in range(len(w) - 2))
    covered = {j + d for j in range(len(w) - 2) if grams[" ".join(w[j:j + 3])] >= 2 for d in range(3)}
    n = len(w)
    base = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered), base)


def _rule_rows():
    rnd = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "consectetur", "adipiscing", "elit", "sed", "do"]
    rows = []
    for i in range(300):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120)))
        if i % 11 == 0:
            text = ("$$$ ### " * 40) + text
        if i % 13 == 0:
            text = "same line here\n" * 5 + text
        rows.append((i, text, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4]))
    rows += [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, " \t\n ", "en", "a"),
             (3, "word " * 60000, "en", "a"), (4, "é" * 5 + " ß\r\nx" * 80, "de", "b")]
    return rows


def test_quality_rules_counts_and_verdict(spark):
    rows = _rule_rows()
    df = spark.createDataFrame([(*r, "clash", "clash", 7, 8) for r in rows], DOCS).repartition(4)
    got = quality_rules.quality_rules(df).collect()
    assert len(got) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = sorted(((r[0],) + brute_rules(r[1]) for r in rows), key=repr)
    assert sorted((tuple([g["doc_id"]] + [g[c] for c in names]) for g in got), key=repr) == want
    assert all(g["base_failed"] is not None and g["kept"] is not None for g in got)
    assert all(not g["kept"] for g in got if g["base_failed"])
    assert {g["score"] for g in got} == {8} and {g["__rules"] for g in got} == {7}
    # symbol-laden documents go, plain ones of fifty words or more stay
    by_id = {g["doc_id"]: g for g in got if g["doc_id"] is not None and g["doc_id"] >= 5}
    assert all(not g["kept"] for i, g in by_id.items() if i % 11 == 0)
    plain = [g for i, g in by_id.items() if i % 11 and i % 13 and not g["base_failed"]]
    assert sum(g["kept"] for g in plain) >= 0.95 * len(plain)


def test_quality_rules_salted_join_agrees(spark, monkeypatch):
    rows = _rule_rows()
    df = spark.createDataFrame([(*r, "clash", "clash", 7, 8) for r in rows], DOCS)
    plain = sorted(map(tuple, quality_rules.quality_rules(df).select("doc_id", "kept", "cutoff_level").collect()), key=repr)
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 0)
    salted = sorted(map(tuple, quality_rules.quality_rules(df).select("doc_id", "kept", "cutoff_level").collect()), key=repr)
    assert plain == salted


def test_quality_rules_of_an_empty_table(spark):
    assert quality_rules.quality_rules(spark.createDataFrame([], DOCS)).count() == 0


# ---------------------------------------------------------------- conversation repair

CONV = "conv_id long, turn long, role string, text string, audit int"


def brute_repair(roles, texts):
    """All edit sequences (at most two inserts in a row), cheapest, then ASCII-least audit."""
    codes = conversation_repair.faults(list(zip(roles, texts)))
    moves = conversation_repair._MOVES
    best = None

    def walk(i, state, cost, audit, out, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(roles) and state in (0, 3):
            cand = (cost, "".join(audit), list(out))
            if best is None or cand[:2] < best[:2]:
                best = cand
        if inserts < 2:
            for role in ("user", "assistant"):
                if role[0] in moves[state]:
                    walk(i, moves[state][role[0]], cost + 5, audit + ["I"], out + [(role, "")], inserts + 1)
        if i == len(roles):
            return
        walk(i + 1, state, cost + 2, audit + ["D"], out, 0)
        if codes[i] in (1, 2):
            return
        extra = 5 if codes[i] == 3 else 0
        if roles[i][:1] in moves[state]:
            walk(i + 1, moves[state][roles[i][:1]], cost + extra, audit + ["K"], out + [(roles[i], texts[i])], 0)
        for role in ("user", "assistant"):
            if role != roles[i] and role[0] in moves[state]:
                walk(i + 1, moves[state][role[0]], cost + 1 + extra, audit + ["R"], out + [(role, texts[i])], 0)

    walk(0, 0, 0, [], [], 0)
    return best


def test_repair_equals_brute_force():
    rnd = random.Random(11)
    roles = ["system", "user", "assistant", " ", "tool"]
    texts = ["Hi.", "ok", "", "  ", "Fine!", "why?"]
    for _ in range(400):
        n = rnd.randint(0, 7)
        r = [rnd.choice(roles) for _ in range(n)]
        t = [rnd.choice(texts) for _ in range(n)]
        cost, audit, out = conversation_repair.repair(r, t)
        want = brute_repair(r, t)
        assert (cost, audit, out) == want, (r, t)


def test_repair_of_a_long_conversation_is_linear_and_checkpointed():
    n = 20000
    roles = [("user", "assistant")[i % 2] for i in range(n)]
    texts = [f"turn {i}." for i in range(n)]
    cost, audit, out = conversation_repair.repair(roles, texts)
    assert cost == 0 and audit == "K" * n and len(out) == n
    roles[5], roles[6] = "user", "assistant"
    cost, audit, _ = conversation_repair.repair(roles, texts)
    assert cost == 2 and audit.count("R") == 2


def _damage(conv_id, turn):
    key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
    return zlib.crc32(key.encode()) % 20


def brute_conversations(rows):
    groups = collections.defaultdict(list)
    ids = set()
    for conv_id, turn, role, text in rows:
        ids.add(conv_id)
        role, text = (" " if role is None else role), (" " if text is None else text)
        d = _damage(conv_id, turn)
        if d == 0:
            continue
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub(r"[.!?]", "", text)
        if d == 4:
            role = "user"
        groups[conv_id] += [(turn, role, text)] * (2 if d == 3 else 1)
    out = []
    for conv_id in ids:
        found = sorted(groups.get(conv_id, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        roles, texts = [r[1] for r in found], [r[2] for r in found]
        codes = conversation_repair.faults(list(zip(roles, texts)))
        initials = [r[:1] for r in roles]
        turns = {r[0] for r in found if r[0] is not None}
        cost, audit, rep = brute_repair(roles, texts)
        out.append((
            conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, codes.count(1), codes.count(2),
            codes.count(3), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rep).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def test_conversations_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for conv in list(range(60)) + [None]:
        for turn in range(rnd.randint(1, 6)):
            rows.append((conv, rnd.choice([turn, turn, None, turn + 3]), rnd.choice(["system", "user", "assistant", None]),
                         rnd.choice(["Hello there.", "ok", None, "", "Sure! ", "Thanks."])))
    rows += [rows[0], rows[1]]
    df = spark.createDataFrame([(*r, 1) for r in rows], CONV).repartition(3)
    got = conversation_repair.repair_conversations(df).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_conversations(rows)


def test_conversation_with_every_row_dropped(spark):
    dropped = [(c, t) for c, t in itertools.product(range(200), range(3)) if _damage(c, t) == 0]
    conv, turn = dropped[0]
    df = spark.createDataFrame([(conv, turn, "user", "Hi.", 1)], CONV)
    (row,) = conversation_repair.repair_conversations(df).collect()
    assert (row["cost"], row["audit"], row["gaps"]) == (0, "", 0)
    assert row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_conversations_of_an_empty_table(spark):
    assert conversation_repair.repair_conversations(spark.createDataFrame([], CONV)).count() == 0
