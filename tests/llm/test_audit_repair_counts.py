"""Filter audit, conversation repair and token counts against brute force and the library."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations, product

import pytest

from incidentlake.llm import conversation_repair, filter_audit, registry, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def model():
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


# --- filter audit ---------------------------------------------------------------

def audit_brute(docs, labels):
    """Every order applied to every document, one after another."""
    lowest = {}
    for i, t, _ in docs:
        if i is not None:
            lowest[t or ""] = min(lowest.get(t or "", i), i)
    good, toxic = {i for i, g, _ in labels if g == 1} - {None}, {i for i, _, x in labels if x == 1} - {None}
    failed = []
    for i, t, _ in docs:
        t = t or ""
        words = WORD.findall(t)
        failed.append("".join(f for f, hit in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and lowest[t] < i), strict=True) if hit))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for step in range(5):
            for (i, _, lang), bad in zip(docs, failed, strict=True):
                row = out.setdefault((lang or "", order, step + 1), [0] * 6)
                gone = set(bad) & set(order[:step])
                hit = order[step] in bad
                row[0] += not gone and not hit
                row[1] += hit and not gone
                row[2] += hit and bool(gone)
                row[3] += bad == order[step]
                row[4] += hit and not gone and i in good
                row[5] += hit and not gone and i in toxic
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] += row[1]
    return {(*k, *row, shapley[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


ORDER = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit(spark, sf_dir, texts):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    found = registry.op11_filter_audit(spark, sf_dir)
    assert {tuple(r) for r in found.select(*ORDER).collect()} == audit_brute(docs, labels)
    long = " ".join(f"w{k}" for k in range(150_000))
    odd = [(1, None, "en"), (2, "", None), (3, "", ""), (None, "", "en"), (None, None, "en"), (4, long, "de"), (5, long, "de"), (5, long, "de"),
           (4, long, "de"), (6, "A" * 50 + "é" * 50, "xx"), (7, "SAME # text", "xx"), (7, "SAME # text", "xx"), (8, "SAME # text", "en"), (None, "SAME # text", "en")]
    odd += [(k, "hot text", "hot") for k in range(100, 400)]
    marks = [(4, 1, 1), (4, 0, None), (5, None, 1), (7, 1, 0), (None, 1, 1), (999, 1, 1), (8, 0, 1)]
    frame = spark.createDataFrame([(i, q == 1 if q is not None else None, t == 1 if t is not None else None) for i, q, t in marks], "id bigint, good boolean, toxic boolean")
    result = filter_audit.audit(texts(odd), frame)
    assert result.count() == 600 * 5
    assert {tuple(r) for r in result.select(*ORDER).collect()} == audit_brute(odd, marks)
    assert filter_audit.audit(texts([]), frame).count() == 0
    no_labels = filter_audit.audit(texts(odd), frame.limit(0))
    assert {tuple(r) for r in no_labels.select(*ORDER).collect()} == audit_brute(odd, [])


def test_carry_save_counters():
    import numpy as np
    rng = np.random.default_rng(4)
    total, counter = [0] * 32, filter_audit.CarrySave()
    for size in (0, 1, 2, 3, 7, 500):
        words = rng.integers(0, 1 << 32, size, np.uint32)
        counts = rng.integers(1, 1 << rng.integers(1, 40), size, np.int64)
        counter.add(words, counts)
        for w, n in zip(words.tolist(), counts.tolist(), strict=True):
            for s in range(32):
                total[s] += n * (w >> s & 1)
        assert counter.totals() == total
    assert filter_audit.survival_words()[0] == (1 << 32) - 1 and filter_audit.survival_words()[31] == 1


# --- conversation repair --------------------------------------------------------

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}


def shortest(rows):
    """Cheapest (cost, audit, lines) over (rows done, state), with a queue instead of spans. rows: role, text, gone, truncated."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        for x in "ua":
            if (state, x) in STEP:
                heapq.heappush(heap, (cost + 2, audit + "I", i, STEP[state, x], (*lines, f"{NAMES[x]}:")))
        if i < len(rows):
            role, text, gone, short = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if not gone:
                if (state, role[:1]) in STEP:
                    heapq.heappush(heap, (cost + short, audit + "K", i + 1, STEP[state, role[:1]], (*lines, f"{role}:{text}")))
                for x in "ua":
                    if (state, x) in STEP:
                        heapq.heappush(heap, (cost + 2 + short, audit + "R", i + 1, STEP[state, x], (*lines, f"{NAMES[x]}:{text}")))


def enumerated(rows):
    """The same by trying all edits, with up to two insertions at each place."""
    best = None
    for extra in product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
        for edits in product("KDua", repeat=len(rows)):
            roles, audit, cost = extra[0], "I" * len(extra[0]), 2 * len(extra[0])
            for (role, _, gone, short), edit, more in zip(rows, edits, extra[1:], strict=True):
                if edit != "D" and gone or edit == "K" and not role:
                    break
                roles += "" if edit == "D" else role[:1] if edit == "K" else edit
                audit += ("R" if edit in "ua" else edit) + "I" * len(more)
                roles += more
                cost += (3 if edit == "D" else (edit != "K") * 2 + short) + 2 * len(more)
            else:
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        ended = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        kind = "blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def repair_brute(table, damage=True):
    conversations = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        mine = conversations[conv]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        kinds = faults([r[1:] for r in rows])
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit, lines = shortest([(role, text, k in ("blank", "duplicate"), k == "truncated") for (_, role, text), k in zip(rows, kinds, strict=True)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                     illegal, cost, audit, sha("\n".join(lines)))
    return out


def result_of(df, conv="conv_id"):
    rows = df.collect()
    found = {r[conv]: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def test_cells_against_enumeration():
    rng = random.Random(8)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(4))]
        rows = [(r, t, g, s and not g) for r, t, g, s in rows]
        cells = [conversation_repair.terminal(r[:1], g, s) for r, _, g, s in rows]
        found = conversation_repair.cheapest(conversation_repair.parsed(cells))
        assert found == enumerated(rows) == shortest(rows)[:2]
        for k in range(1, len(cells)):  # any split of a span gives the same cell
            both = conversation_repair.combined(conversation_repair.parsed(cells[:k]), conversation_repair.parsed(cells[k:]))
            assert both == conversation_repair.parsed(cells)


def test_conversation_repair(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result_of(registry.op12_conversation_repair(spark, sf_dir)) == repair_brute(rows)


@pytest.mark.parametrize("segment", [1, 3, 1024])
def test_conversation_repair_odd(spark, segment):
    from pyspark.sql import functions as F
    rng = random.Random(3)
    say = ["Yes.", "No!", "Open", " ", "", "Why? ", "Tail.\n\n", "Half, ", "x" * 3000 + ".", "é 日本。"]
    rows = [(conv, turn, rng.choice(["user", "assistant", "system", "tool", "User", "", None]), rng.choice([*say, None]))
            for conv in [*range(40), None] for turn in [*range(rng.randrange(9)), *([None] * (conv is None or conv % 7 == 0))]]
    rows += rows[::5]  # repeated rows and ties
    rows += [(77, turn, "user" if turn % 2 == 0 else "assistant", f"text {turn % 90}.") for turn in range(1500)]  # one long conversation
    rows += [(78, 5, "user", "again.")] * 300 + [(79, None, None, None)] * 3 + [(80, 10**17, "user", "a."), (80, 3, "assistant", "b.")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({k: F.lit(7) for k in ("conv", "copies", "r", "part")})
    assert result_of(conversation_repair.repair_conversations(frame, conversation_repair.damage_key(), segment=segment)) == repair_brute(rows)
    if segment == 3:
        assert result_of(conversation_repair.repair_conversations(frame, segment=segment)) == repair_brute(rows, damage=False)
        assert conversation_repair.repair_conversations(frame.limit(0), conversation_repair.damage_key()).count() == 0


# --- token counts ---------------------------------------------------------------

ODD = [None, "", " ", "  ", " a", "a ", "a  b", "▁", "▁▁a▁", " ▁ ", "é 日本 😀", "\t\n x", "</s> <s> <unk>", "x" * 5000, "ab" * 3000 + " end", "日本" * 500, "\u0000a", "é", "a b"]


def test_token_counts(spark, sf_dir, small_docs, texts):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model())
    found = {r.doc_id: r for r in registry.op13_token_counts(spark, sf_dir).collect()}
    assert len(found) == len(small_docs)
    for i, text in small_docs:
        n = len(sp.encode(text or ""))
        assert (found[i].n_bytes, found[i].n_tokens, found[i].over_limit) == (len((text or "").encode()), n, n > 4096)
    rng = random.Random(2)
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(None, "no id", "en"), (3, "tie", "en"), (3, "tie", "en")]
    rows += [(100 + k, "".join(rng.choice("ab é▁ th.,日\n") for _ in range(rng.randrange(60))), "en") for k in range(400)]
    counted = token_counts.count_tokens(texts(rows), model(), keys=("doc_id", "text"), limit=1)
    result = counted.collect()
    assert len(result) == len(rows) and all(r.n_tokens == len(sp.encode(r.text or "")) and r.over_limit == (r.n_tokens > 1) for r in result)
    assert token_counts.count_tokens(texts([]), model()).count() == 0


def test_token_count_caches(monkeypatch):
    """Counts do not depend on the cache or on where texts are cut; one text of over a megabyte."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model())
    merges = token_counts.Merges(model())
    whole = token_counts.Merges(model())
    whole.cuts = False
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 2000)
    rng = random.Random(6)
    for _ in range(300):
        text = " ".join("".join(rng.choice("aeiouthn.é") for _ in range(rng.randrange(12))) for _ in range(9))
        assert merges.count(text) == whole.count(text) == len(sp.encode(text))
        assert merges.held <= 2000 + 4 * 64 + 120
    long = "no spaces at all".replace(" ", "") * 80_000
    assert merges.count(long) == len(sp.encode(long))
