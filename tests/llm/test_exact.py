"""Operators with exact results against brute force, over a whole small table and over hand-made rows."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from incidentlake.llm import bucket_counts, common, jaccard_join, line_dedup, quality, registry, sentencepiece_codec, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None, "en"), (2, "", None), (3, " \n\t ", "xx"), (None, "no id here", "en"), (5, "a b", "en"), (6, "A  B", "de"),
    (7, "x" * 3000 + " end", "en"), (8, "dup row " * 60, "en"), (8, "dup row " * 60, "en"), (9, "é à ▁ 😀 日本", "fr"), (10, "tie", "en"), (11, "tie", "en"),
]


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def model():
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def test_sentencepiece(spark, sf_dir, small_docs, texts):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model())
    found = {r.doc_id: r for r in registry.op1_sentencepiece(spark, sf_dir).collect()}
    assert len(found) == len(small_docs)
    for i, text in small_docs:
        ids = sp.encode(text or "") + [sp.eos_id()]
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids)).encode()), sha(sp.decode(ids).encode()))
    odd = texts(ODD)
    encoded = sentencepiece_codec.encode(odd, model(), keys=("doc_id", "text"))
    rows = encoded.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.ids == sp.encode(r.text or "") + [sp.eos_id()] and r.decoded == sp.decode(list(r.ids))
    back = sentencepiece_codec.decode(encoded, model(), keys=("text",)).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)
    assert sentencepiece_codec.encode(texts([]), model()).count() == 0


def test_sentencepiece_checks(monkeypatch):
    """Decoded texts come from ids, caches do not change results, and a differing library is an error."""
    c = sentencepiece_codec.Codec(model())
    monkeypatch.setattr(sentencepiece_codec, "CACHE_PARTS", 3)
    many = [f"part{k} é{k}. 日{k} ▁x  y{k}" for k in range(50)]
    for batch in (many[:20], many[20:], ["a", None, ""]):
        ids, decoded = sentencepiece_codec.encode_batch(c, batch, ["ids", "decoded"], [], [2])
        for text, i, d in zip(batch, ids.to_pylist(), decoded.to_pylist(), strict=True):
            assert i == c.library.encode(text or "") + [2] and d == c.library.decode(i)
    c.piece_of[str(c.library.piece_to_id("▁and"))] = "▁or"
    with pytest.raises(ValueError):
        sentencepiece_codec.encode_batch(c, ["this and that"], ["n_tokens"], [], [])


def test_worker_caches(texts):
    """A worker keeps an operator's cache for its next task, and not beside the memory of another operator."""
    def codecs(batches):
        for batch in batches:
            yield batch.assign(n=len(sentencepiece_codec._CODECS))[["n"]]

    docs = texts([(1, "a b", "en")]).coalesce(1)
    sentencepiece_codec.codec(model())
    assert list(common.taken(iter("ab"), "sentencepiece")) == ["a", "b"] and sentencepiece_codec._CODECS
    assert list(common.taken(iter("ab"))) == ["a", "b"] and not sentencepiece_codec._CODECS

    def after_another(batches):
        sentencepiece_codec.codec(held)
        assert not list(bucket_counts._summed(iter([])))
        yield from codecs(batches)

    held = model()
    assert [r.n for r in docs.mapInPandas(after_another, "n long").collect()] == [0]


def base_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts(spark, sf_dir, small_docs, texts):
    labels = spark.createDataFrame([], "id bigint, good boolean")
    rows = [(i, t, "en") for i, t in small_docs] + [(i or 0, t, s) for i, t, s in ODD]
    found = quality.quality_verdicts(texts(rows), labels).collect()
    assert len(found) == len(rows)
    by_id = defaultdict(set)
    for i, t, _ in rows:
        by_id[i].add(base_counts(t))
    for r in found:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts in by_id[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels no cutoff is in force


def test_quality_cutoffs(spark, texts):
    from fractions import Fraction
    from math import comb
    good = [(i, f"plain words of document {i} " * 2 + " ".join(f"w{i}x{k}" for k in range(30)), "en") for i in range(2000)]
    bad = [(i, " ".join(f"w{i}x{k}###" for k in range(30)), "en") for i in range(2000, 2400)]
    docs = texts(good + bad + [(9000, " ".join(f"d{k}###" for k in range(30)), "de")])
    labels = spark.createDataFrame([(i, i < 2000) for i in range(2400)] + [(None, True), (77777, False)], "id bigint, good boolean")
    kept = {r.doc_id: r.kept for r in quality.quality_verdicts(docs, labels).collect()}
    assert all(kept[i] for i in range(2000)) and not any(kept[i] for i in range(2000, 2400))
    assert kept[9000]  # no labels in this stratum, so no rejection by the method
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == 2001
    tail = spark.createDataFrame([(3, 1500), (0, 10), (40, 4000), (30, 3000)], "k bigint, n bigint") \
        .select("k", "n", quality.binomial_tail("k", "n", 0.01).alias("p")).collect()
    for r in tail:
        exact = float(Fraction(sum(comb(r.n, i) * 99 ** (r.n - i) for i in range(r.k + 1)), 100 ** r.n)) if r.k < r.n * 0.01 else 1.0
        assert r.p == pytest.approx(exact, rel=1e-9)


def repeated(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept)))
    return out


def test_suffix_dedup(spark, texts, small_docs, monkeypatch):
    base = "".join(f"{k} some long text {k * k} " for k in range(400))
    rows = [(i, t, "en") for i, t in small_docs[:120]] + ODD + [
        (100, base, "en"), (101, base[:1500] + "!" + base[1501:], "en"), (102, "zz" + base[700:899], "en"), (103, "zz" + base[700:900], "en"),
        (104, "ab" * 500, "en"), (105, "q" + base[3000:3400] + "?" + base[3000:3300], "en"), (106, "a" * 199, "en"), (107, "b" * 200, "en"), (108, "c" * 201, "en")]
    expected = Counter((i, *x) for (i, _, _), x in zip(rows, repeated([t for _, t, _ in rows], 200), strict=True))
    found = Counter(tuple(r) for r in suffix_dedup.digests(suffix_dedup.remove_repeats(texts(rows))).collect())
    assert found == expected
    assert suffix_dedup.remove_repeats(texts([])).count() == 0


def test_suffix_pieces(monkeypatch):
    """Cutting a long text into pieces loses and adds no suffix."""
    import numpy as np
    text = np.random.default_rng(1).integers(97, 100, 5000, np.uint8).tobytes()
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    seen = []
    for data, inside in suffix_dedup._pieces([text, b"short", text[:1100]]):
        k, offset, start, stop = np.array(inside, np.int64).T
        _, _, piece, first, more, _ = suffix_dedup.stretches(np.frombuffer(data, np.uint8), start, stop)
        for p, f, m in zip(piece, first, more, strict=True):
            seen += [(int(k[p]), int(f - start[p] + offset[p] + x)) for x in range(m + 1)]
    assert sorted(seen) == [(0, i) for i in range(4801)] + [(2, i) for i in range(901)]


def test_line_dedup(texts, small_docs):
    passage = "\n".join(" ".join(f"p{k}w{j}" for j in range(20)) for k in range(6))
    long_line = " ".join(f"l{j}" for j in range(60))
    hot = "hot line of five words"
    rows = sorted(small_docs)[:150] + [
        (1001, f"intro\n{passage}\nend"), (1002, f"other\n\n{passage}\nrest"), (1003, f"{hot}\n{long_line}\ntail"), (1004, f"another start\n{long_line}"),
        (1005, passage.split("\n")[0] + "\nx"), (1006, "\n".join(["again and again five words"] * 30)), (1007, None), (1008, "")]
    df = texts([(i, t, "en") for i, t in rows])
    done = line_dedup.dedup_lines(df)
    assert done.columns == [*df.columns, "n_lines", "n_removed"]
    assert {r.doc_id: r.text for r in done.collect()} == dict(zip([i for i, _ in rows], runs_removed(rows), strict=True))
    assert {r.doc_id: r.text for r in done.filter("doc_id > 1000").collect()}[1004] == "another start"
    assert line_dedup.dedup_lines(texts([])).count() == 0
    huge = "\n".join(f"{k} " + " ".join(f"h{k}x{j}" for j in range(9)) for k in range(30_000))  # over a megabyte
    both = line_dedup.dedup_lines(texts([(1, huge, "en"), (2, "own line\n" + huge + "\nlast", "en")])).collect()
    assert {r.doc_id: (r.n_removed, r.text) for r in both} == {1: (0, huge), 2: (30_000, "own line\nlast")}
    twice = line_dedup.dedup_lines(texts([(1, passage, "en"), (1, passage, "en"), (None, passage, "en")])).collect()
    assert sorted(r.n_removed for r in twice) == [0, 6, 6]  # the null id comes first, equal rows are alike


def runs_removed(rows, min_words=50):
    """Every stretch of lines with enough words, of any length, that has stood before, in the order of (id, row, line), is deleted."""
    first, stretches = {}, []
    for r, (i, text) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[0])):
        lines = [(k, x.strip()) for k, x in enumerate(text.split("\n") if text else []) if x.strip()]
        for s in range(len(lines)):
            total, run = 0, hashlib.sha256()
            for k, x in lines[s:]:
                total += len(x.split())
                run.update(f"{x}\n".encode())
                if total >= min_words:
                    stretches.append((run.digest(), r, lines[s][0], k))
                    first.setdefault(run.digest(), (r, lines[s][0]))
    gone = defaultdict(set)
    for w, r, s, e in stretches:
        if first[w] != (r, s):
            gone[r] |= set(range(s, e + 1))
    return ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[r]) if t else t for r, (_, t) in enumerate(rows)]


def test_line_dedup_whole_runs(texts, small_docs):
    def line(name, n):
        return " ".join(f"{name}{j}" for j in range(n))
    run = [line("a", 60), line("b", 45)]
    short = [line("c", 60), *[line(f"d{k}", 5) for k in range(15)], "", line("e", 1)]
    rows = sorted(small_docs)[:150] + [(1001, "\n".join(["head", *run, "tail"])), (1002, "\n".join(["start", *run, "stop"])),
        (1003, "\n".join(["x", run[0]])), (1004, "\n".join(["y", run[1]])), (1005, "\n".join(short)), (1006, "\n".join(["z", *short, "last"])),
        (1007, "\n".join(short[:9] + ["other"])), (1008, "\n".join(["own words"] + short[4:] + ["more"])), (1009, "\n".join([line("f", 5)] * 40))]
    found = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(texts([(i, t, "en") for i, t in rows])).collect()}
    assert found[1002] == ("start\nstop", 2)
    assert found[1004] == (f"y\n{run[1]}", 0)  # 45 words alone are no run
    assert found[1006] == ("z\nlast", 18)
    assert {i: t for i, (t, _) in found.items()} == dict(zip([i for i, _ in rows], runs_removed(rows), strict=True))


def shingled(text, k):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def jaccard_brute(rows, k, num, den):
    sets = [shingled(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = defaultdict(list)
    for r, s in enumerate(sets):
        for x in s:
            where[x].append(r)
    for r, s in enumerate(sets):
        for q in {q for x in s for q in where[x] if q < r}:
            both = len(s & sets[q])
            if den * both >= num * (len(s) + len(sets[q]) - both):
                parent[max(root(r), root(q))] = min(root(r), root(q))
    names = defaultdict(list)
    for r, (i, _) in enumerate(rows):
        names[root(r)].append(i)
    return Counter((i, len(sets[r]), min((x for x in names[root(r)] if x is not None), default=None)) for r, (i, _) in enumerate(rows))


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_jaccard(texts, small_docs, k, num, den):
    import random
    rng = random.Random(5)
    words = [f"v{j}" for j in range(900)]
    base = [rng.choice(words) for _ in range(150)]
    near = []
    for copy in range(60):  # a group whose members lie on both sides of the threshold
        w = list(base)
        for _ in range(copy % 9):
            w[rng.randrange(150)] = rng.choice(words)
        near.append((500 + copy, " ".join(w)))
    rows = small_docs + near + [(i, t) for i, t, _ in ODD] + [(900 + j, "one two three four" + " five" * (j % 2)) for j in range(6)]
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(texts([(i, t, "en") for i, t in rows]), words=k, num=num, den=den).collect())
    assert found == jaccard_brute(rows, k, num, den)


def test_jaccard_hot_tokens(texts):
    """Tokens that very many unlinked sets hold, and groups whose members lie on both sides of the threshold."""
    import random
    rng = random.Random(9)
    words = [f"t{j}" for j in range(400)]
    hot = " ".join(f"h{j}" for j in range(11))
    rows = [(i, f"{hot} a{i} b{i} c{i}") for i in range(1500)]
    template = [rng.choice(words) for _ in range(90)]
    for i in range(2000, 2120):  # five to twelve own words in a template: some linked, most not
        w = list(template)
        for _ in range(rng.choice([1, 2, 3])):
            at = rng.randrange(85)
            w[at:at + 1] = [f"own{i}x{at}"]
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(template[:60 + i % 31])) for i in range(3000, 3090)]  # sizes in several blocks
    docs = texts([(i, t, "en") for i, t in rows])
    for k, num, den in ((3, 90, 100), (5, 80, 100)):
        found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, words=k, num=num, den=den).collect())
        assert found == jaccard_brute(rows, k, num, den)


def test_jaccard_near_copies_of_one_text(texts, monkeypatch):
    """Copies with a few words of their own are compared with the text they were made from, not with each other."""
    import random
    rng = random.Random(7)
    base, rows = [f"base{k}" for k in range(150)], []
    for i in range(240):
        words = base.copy()
        for j in range(i % 4):
            words[rng.randrange(150)] = f"own{i}x{j}"
        rows.append((i, " ".join(words)))
    compared, verified = [], jaccard_join._verified

    def counted(all_rows, nodes, pairs, words, t):
        compared.append(pairs.count())
        return verified(all_rows, nodes, pairs, words, t)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(texts([(i, t, "en") for i, t in rows])).collect())
    assert found == jaccard_brute(rows, 3, 90, 100)
    assert len(compared) == 3 and compared[2] <= len(rows) // 2


def test_jaccard_empty(texts):
    assert jaccard_join.jaccard_components(texts([])).count() == 0
