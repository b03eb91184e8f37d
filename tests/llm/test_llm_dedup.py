"""Exact dedup, Jaccard join and substring dedup against brute force, with nulls, ties, repeats, long and empty texts."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import exact_dedup, jaccard, substring

DDL = "doc_id bigint, text string, _norm string, text_sha256 int"  # further columns with clashing names


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DDL)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


MIXED = [(5, "a  b"), (3, "a\tb"), (3, "a b"), (9, None), (8, ""), (7, " "), (6, "\n"), (None, "a b"), (None, "only null"),
         (2, "long " * 30000), (1, "long " * 30000), (4, "unique é")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, lambda t: F.length(t) % 2])
def test_exact_dedup_matches_brute_force_even_when_digests_collide(spark, digest, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 4)  # some digests are hot
    got = exact_dedup.dedup_classes(docs_of(spark, MIXED), digest=digest, salts=3).collect()
    groups = {}
    for i, t in MIXED:
        groups.setdefault(norm(t), []).append(i)
    expected = []
    for i, t in MIXED:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        expected.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    out = exact_dedup.drop_copies(docs_of(spark, MIXED + MIXED[:2]))
    assert out.columns == ["doc_id", "text", "_norm", "text_sha256"]
    rows = [(r[0], norm(r[1])) for r in out.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, [(3, "a b"), (8, ""), (6, " "), (None, "only null"), (1, norm("long " * 30000)),
                                                         (4, "unique é")]))


def test_empty_tables(spark):
    empty = docs_of(spark, [])
    assert exact_dedup.dedup_classes(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0
    assert substring.remove_repeats(empty).count() == 0


def near_rows(seed, n=120):
    """Families of near copies of bases of 60 words, some bases absent, plus unrelated, short, empty and repeated rows."""
    r = random.Random(seed)
    word = lambda: "w%d" % r.randint(0, 4000)
    common, rows = [word() for _ in range(14)], []
    bases = [[word() for _ in range(60)] for _ in range(4)]
    for i in range(n):
        text = list(r.choice(bases))
        for _ in range(r.randint(0, 7)):
            at = r.randrange(len(text))
            text[at:at + r.choice([1, 1, 0, 2])] = [word()] * r.choice([1, 1, 0])
        rows.append((i, " ".join(text + (common if r.random() < 0.3 else []))))
    rows += [(n + i, " ".join(word() for _ in range(r.randint(0, 40))) or None) for i in range(40)]
    rows += [(900, "One two"), (901, "one  TWO"), (902, "one"), (903, ""), (904, None), (None, "one two"), (None, "solo null"),
             (3, rows[3][1]), (5, "another text of id five entirely"), (905, "ab " * 3000 + "tail"), (906, "ab " * 3000 + "tail")]
    r.shuffle(rows)
    return rows


def jaccard_brute(rows, k, num, den):
    def shingles(t):
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(t)]
        return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    big = 1 << 70
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), big), big if d is None else d)
    return [(d, len(s), None if least[find(i)] == big else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("k,num,den,small", [(3, 9, 10, 24), (3, 9, 10, 1), (5, 4, 5, 2)])
def test_jaccard_components_match_all_pairs(spark, monkeypatch, k, num, den, small):
    monkeypatch.setattr(jaccard, "SMALL", small)  # deal buckets anew by edits
    rows = near_rows(k + small)
    got = [tuple(x) for x in jaccard.near_duplicates(docs_of(spark, rows), k=k, num=num, den=den).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, jaccard_brute(rows, k, num, den)))


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    base = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(4, base), (2, base + " u"), (9, "x y z one two three four"), (7, None), (6, "")]
    out = jaccard.drop_near_duplicates(docs_of(spark, rows))
    assert out.columns == ["doc_id", "text", "_norm", "text_sha256"]
    assert sorted(r[0] for r in out.collect()) == [2, 6, 7, 9]


def removal_brute(rows, k):
    big = 1 << 70
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, big), big if d is None else d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < (big if d is None else d):
                gone[i:i + k] = [True] * k
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("block", [1, 50, 2_000_000])
def test_substring_removal_matches_brute_force(spark, block):
    r = random.Random(block)
    passages = [" ".join("p%d" % r.randint(0, 500) for _ in range(r.randint(10, 40))) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [" ".join("u%d" % r.randint(0, 10 ** 6) for _ in range(r.randint(0, 15))) for _ in range(3)]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages).split()
            cut = r.randint(0, len(p) // 3)
            parts.insert(r.randint(0, len(parts)), " ".join(p[cut:len(p) - r.randint(0, 5)]))
        rows.append((r.randint(0, 70), "  ".join(parts)))
    rows += [(100, None), (101, ""), (102, " "), (None, passages[0] + " and more"), (None, passages[0]), (103, rows[0][1]),
             (103, rows[0][1]), (104, "same " * 40), (105, "same " * 2000), (99, "x" * 300 + " y" * 13 + " z"),
             (106, "x" * 300 + " y" * 13 + " z")]
    got = [tuple(x) for x in substring.remove_repeats(docs_of(spark, rows), block=block).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, removal_brute(rows, 13)))


def test_word_hashes_tell_words_apart_across_stretches(monkeypatch):
    r = random.Random(4)
    text = " ".join("v%d" % r.randint(0, 300) * r.randint(1, 30) for _ in range(3000)).encode()
    whole = substring.word_hashes(text).tolist()
    monkeypatch.setattr(substring, "_STRETCH", 1 << 12)
    substring._POWERS.clear()
    assert substring.word_hashes(text).tolist() == whole
    substring._POWERS.clear()
    assert len(set(zip(text.split(), whole))) == len(set(text.split())) == len(set(whole))


def test_words_behind_an_oversize_word_keep_their_hashes(spark):
    """A word beyond a stretch (1 MiB) in front of, between and behind passages that other documents have."""
    r = random.Random(8)
    passage = lambda: " ".join("q%d" % r.randint(0, 10 ** 6) for _ in range(60))
    a, b = passage(), passage()
    big = ["%d" % i * ((1 << 20) + 5 + i) for i in (1, 2)]
    for text in (f"{big[0]} {a}", f"{a} {big[0]}\t {b}", f"{big[0]} {big[1]}", big[0] + "\n"):
        hashes = substring.word_hashes(text.encode()).tolist()
        assert hashes == [substring.word_hashes(w)[0] for w in substring.words_of(text)]
    rows = [(1, a), (2, f"{big[0]} {a}"), (3, f"{big[1]} {b}"), (4, b + " tail"), (5, f"{a} {big[1]} {b}"), (6, f"{a} {big[0]} {b}")]
    got = [tuple(x) for x in substring.remove_repeats(docs_of(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, removal_brute(rows, 13)))
    got = [tuple(x) for x in jaccard.near_duplicates(docs_of(spark, rows), k=3).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, jaccard_brute(rows, 3, 4, 5)))
    assert len({c for i, _, c in got if i in (1, 2)}) == 1


def test_different_texts_of_one_id_are_judged_apart(spark):
    """Null ids and a repeated id: a row with a near copy elsewhere goes, clean rows of its id stay and link with nothing."""
    r = random.Random(3)
    text = lambda: " ".join("t%d" % r.randint(0, 10 ** 6) for _ in range(30))
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [(1, a), (None, a + " end"), (None, b), (2, c), (7, c + " end"), (7, d), (8, d + " end"), (None, e), (None, e + " end"), (9, b + " end"), (7, f),
            (7, f)]
    got = [tuple(x) for x in jaccard.near_duplicates(docs_of(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, jaccard_brute(rows, 5, 4, 5)))
    left = sorted(repr((x[0], x[1])) for x in jaccard.drop_near_duplicates(docs_of(spark, rows)).collect())
    assert left == sorted(map(repr, [(1, a), (2, c), (7, d), (7, f), (7, f), (9, b + " end"), (None, e), (None, e + " end")]))


def test_each_text_of_a_repeated_id_gets_its_own_runs_alone(spark, monkeypatch):
    """Null ids and a repeated id: what is joined to a text is its own, not that of all texts of its id."""
    r = random.Random(6)
    passage = [" ".join("p%d" % r.randint(0, 10 ** 6) for _ in range(20)) for _ in range(12)]
    rows = [(i, p) for i, p in enumerate(passage)] + [(None, p + " n") for p in passage] + [(50, p + " m") for p in passage]
    rows += [(None, passage[0] + " n"), (50, passage[0] + " m"), (60, passage[3] + " m")]
    sizes, kept = [], substring._kept

    def seen(docs, k):
        sizes.extend(x[0] for x in docs.select(F.size("spans")).where("spans is not null").collect())
        return kept(docs, k)
    monkeypatch.setattr(substring, "_kept", seen)
    runs = substring._shared_runs
    joined = []

    def seen_runs(docs, *args):
        out = runs(docs, *args)
        joined.append(docs.join(out, [c for c in out.columns if c != "runs"]).agg(F.max(F.size("runs"))).first()[0])
        return out
    monkeypatch.setattr(substring, "_shared_runs", seen_runs)
    got = [tuple(x) for x in substring.remove_repeats(docs_of(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, removal_brute(rows, 13)))
    assert sorted(sizes) == [1] * 26 + [2]  # id 60 has its last window from id 50; by id alone 13 for each text of id 50
    assert joined[0] <= 9  # a text of 21 words has 9 windows


@pytest.mark.parametrize("num,den", [(9, 10), (4, 5), (1, 2)])
def test_linked_sets_share_a_signature(num, den):
    """Sets from one token on, changed by as much as a link allows: where parts are empty too. Sketches never differ by more than the sets."""
    r, linked = np.random.default_rng(num), 0
    for _ in range(3000):
        s = np.unique(r.integers(-1 << 63, (1 << 63) - 1, int(r.choice([r.integers(1, 12), r.integers(2, 60), r.integers(50, 400)]))))
        gone, new = r.integers(0, len(s) * (den - num) // den + 1), r.integers(0, len(s) * (den - num) // num + 2)
        t = np.unique(np.concatenate([r.permutation(s)[gone:], r.integers(-1 << 63, (1 << 63) - 1, new)]))
        shared = len(np.intersect1d(s, t))
        apart = len(s) + len(t) - 2 * shared
        if not apart or den * shared < num * (shared + apart):
            continue
        linked += 1
        assert len(np.intersect1d(jaccard.signatures(s, num, den), jaccard.signatures(t, num, den)))
        a, b = sorted((jaccard.sketch(s), jaccard.sketch(t)), key=len)
        if len(b) == 2 * len(a):
            b = b[:len(a)] ^ b[len(a):]
        assert len(a) != len(b) or np.bitwise_count((a ^ b).view(np.uint64)).sum() <= apart
    assert linked > 300


def test_documents_that_only_share_a_passage_are_not_taken_apart(spark, monkeypatch):
    """Half of each text is one passage: no group is dealt by edits, which would be written once per document and group."""
    r = random.Random(12)
    word = lambda: "w%d" % r.randint(0, 10 ** 6)
    passage = " ".join(word() for _ in range(60))
    rows = [(i, passage + " " + " ".join(word() for _ in range(60))) for i in range(150)]
    rows += [(200 + i, rows[i][1] + " end") for i in range(20)]
    written, cut = [], jaccard.Scratch.cut

    def spy(self, df, name):
        out = cut(self, df, name)
        written.append((name, out.count() if "edits" in name else 0))
        return out
    monkeypatch.setattr(jaccard.Scratch, "cut", spy)
    got = [tuple(x) for x in jaccard.near_duplicates(docs_of(spark, rows), k=3, num=9, den=10).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, jaccard_brute(rows, 3, 9, 10)))
    assert not sum(n for _, n in written)
