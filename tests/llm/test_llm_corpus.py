"""Phrases, spelling variants and sentence pieces against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("msgloom.llm")

from msgloom.llm import phrases, pieces, spelling  # noqa: E402
from msgloom.llm.queries import piece_bpe  # noqa: E402

#: Extra columns take names that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, word string, n long, h long, phrase string, chunk string"
EXTRA = ("x", 1, 2, "y", "z")


def prose(n: int, seed: int, vocabulary: int = 60) -> str:
    own = random.Random(seed)
    words = ["".join(own.choice("abcdeéf") for _ in range(own.randint(4, 7))) for _ in range(vocabulary)]
    names = [words[min(own.randrange(vocabulary), own.randrange(vocabulary))] for _ in range(n)]
    return " ".join(w + (own.choice([",", ".", "!\n", ""]) if own.random() < 0.2 else "") for w in names)


def rows() -> list[tuple]:
    texts = {i: prose(300, i % 4) for i in range(12)}  # repeated texts
    texts |= {20: None, 21: "", 22: " \t\n", 23: "...", 24: "Solo", 25: "ÀÉ×÷ Straße " * 3, 26: prose(20_000, 5)}
    texts |= {27: "xyz " * 3000, 28: "one. two, three! four? five; six", 29: "a\x0bb\x0cc d▁e  ▁▁f \U0001f600 12 345"}
    made = [(i, t, ["en", "fr", None][i % 3], *EXTRA) for i, t in texts.items()]
    return [*made, made[3], made[3], (None, prose(200, 1), "en", *EXTRA), (None, prose(200, 1), "en", *EXTRA)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_phrases(table: list[tuple], least: int, top: int) -> list[tuple]:
    counts, total = Counter(), Counter()
    for _, text, lang, *_ in table:
        lang = lang or "und"
        text = lower(text)
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, ".")
        for piece in text.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        inside = any(
            len(q) > len(p) and other == lang and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in candidates.items()
        )
        if not inside:
            n = total[lang]
            cuts = [(counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
            score, _, le, r = min((1000 * a * n // (le * r), k, le, r) for k, (le, r) in enumerate(cuts))
            out[lang].append((-score, -a, " ".join(p).encode(), le, r, n))
    return sorted(
        (lang, i, p.decode(), -a, le, r, n, -s)
        for lang, found in out.items()
        for i, (s, a, p, le, r, n) in enumerate(sorted(found)[:top], 1)
    )


@pytest.mark.parametrize(("trigger", "bits"), [(32, 1 << 27), (1, 1 << 15), (10**6, 1 << 15)])
def test_phrases_match_brute_force(docs, trigger, bits):
    got = sorted(tuple(r) for r in phrases.collocations(docs, 12, 150, trigger, bits).collect())
    assert got == brute_phrases(rows(), 12, 150)
    assert len(got) > 150


def test_phrases_of_empty_tables(docs, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(docs.filter("text is null or text in ('', '...')")).count() == 0


def test_each_phrase_begins_in_one_chunk():
    found = phrases.tokens(prose(5000, 3))
    for trigger, longest in ((1, 10), (8, 64), (10**9, 50)):
        parts = list(phrases.chunks(found, trigger, longest))
        starts = [a + i for a, core, _ in parts for i in range(core)]
        assert starts == list(range(len(found)))
        assert all(z >= min(len(found), a + core + phrases.WINDOW) for a, core, z in parts)
    # Equal passages give equal chunks inside, wherever they stand.
    passage = phrases.tokens(prose(3000, 9))
    one, two = [*found[:101], *passage], [*found[:1717], *passage]
    cut = lambda t: {tuple(t[a:z]) for a, _, z in phrases.chunks(t)}
    assert len(cut(one) & cut(two)) > 50


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**13
    f = [("en", "a b", 2, big), ("en", "a", 1, big + 7), ("en", "b", 1, big + 3)]
    found = spark.createDataFrame(f, "lang string, phrase string, size int, n long")
    total = spark.createDataFrame([("en", 9 * 10**14 + 1)], "lang string, n long")
    (row,) = phrases.scored(found, total).collect()
    assert row["score"] == 1000 * big * (9 * 10**14 + 1) // ((big + 7) * (big + 3))


def test_bitmap_holds_all_hashes(spark):
    own = random.Random(1)
    h = [own.getrandbits(64) for _ in range(5000)] + [0, 1, 2, 3, 2**64 - 1]
    signed = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in h], "h long")
    for bits in (1 << 15, 1 << 27):
        made = phrases.bitmap(signed, bits)
        assert made.holds(phrases.np.array(h, "u8")).all()
    other = phrases.np.array([own.getrandbits(64) for _ in range(5000)], "u8")
    assert made.holds(other).mean() < 0.1


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_variants(table: list[tuple]) -> list[tuple]:
    counts = Counter()
    for doc, text, *_ in table:
        run = ""
        for c in lower(text) + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
            run = ""
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    beside = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in beside.items() if vs}
    form = {w: v if n[v] >= 2 * n[w] else None for w, v in best.items()}

    def root(w: str) -> str:
        return root(form[w]) if form.get(w) else w

    return sorted((w, form.get(w) or "", root(w), c, len(beside[w]), n[form[w]] if form.get(w) else 0) for w, c in n.items())


def spelled(df) -> list[tuple]:
    return sorted((r[0], r[1] or "", r[2], r[3], r[4], r[5] or 0) for r in df.collect())


def test_variants_match_brute_force(docs, empty):
    got = spelled(spelling.variants(docs))
    assert got == brute_variants(rows())
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(docs.filter("text is null")).count() == 0


@pytest.mark.parametrize(("segments", "tile"), [(1, 7), (2, 3), (3, 2048), (4, 5)])
def test_near_words_of_one_hot_block(spark, segments, tile):
    own = random.Random(4)
    names = {"".join(own.choice("ab") for _ in range(own.randint(4, 6))) + "tail" + "".join(own.choice("abé") for _ in range(2)) for _ in range(150)}
    names |= {"z" * 3000, "z" * 2999, "z" * 2998 + "y", "aaaaa", "aaaaaa", "baaaa", "aaaab", "short", "shor"}
    n = {w: own.randint(3, 6) for w in names}
    counted = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best"]) for r in spelling.near_words(counted, segments, tile).collect()}
    beside = {w: [v for v in n if near(w, v)] for w in n}
    assert got == {w: (len(vs), min(vs, key=lambda v: (-n[v], v))) for w, vs in beside.items() if vs}


def test_roots_follow_long_ways(spark):
    way = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("x", "w40"), ("y", "z")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(way, "word string, form string")).collect()}
    assert got == {f"w{i}": "w40" for i in range(40)} | {"x": "w40", "y": "z"}


def plain_pieces(table: list[tuple]) -> list[tuple]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_bpe())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for doc, text, *_ in table:
        ids = model.encode(text or "", add_eos=True)
        out.append((-1 if doc is None else doc, len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    return sorted(out)


def odd_rows() -> list[tuple]:
    own = random.Random(8)
    alphabet = list("aAzé0129 ▁\t\n.,;:()[]'\"<>/s|_-=%& 　́中文ไทยﬁ½\U0001f600\x00\x1c") + ["</s>", "<s>", "<0x41>", " the", "ing ", "  ", "http://"]
    return [(i, "".join(own.choice(alphabet) for _ in range(own.randint(1, 80))), None, *EXTRA) for i in range(400)]


@pytest.mark.parametrize("table_rows", [400_000, 20, 0])
def test_pieces_match_the_library(spark, table_rows):
    table = rows() + odd_rows()
    docs = spark.createDataFrame(table, SCHEMA).repartition(3)
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, pieces.digests(docs, piece_bpe(), table_rows).collect()))
    assert got == plain_pieces(table)


def test_pieces_whole_output_and_empty_table(spark, docs, empty):
    assert pieces.digests(empty, piece_bpe()).count() == 0
    few = docs.filter("doc_id in (20, 24)")
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in pieces.encoded(few, piece_bpe()).collect()}
    assert got[20] == ([2], "")
    assert got[24][1] == "Solo"
    assert got[24][0][-1] == 2


def test_table_is_bounded_and_segments_once(docs):
    made = pieces.chunk_table(docs, piece_bpe(), 30).collect()
    assert 0 < len(made) <= 30
    assert len({r["chunk"] for r in made}) == len(made)
