"""Chat formatting, mixing, packing, fingerprints and personal data against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from minewright.llm import chat, mixing, packing, pii, simhash
from minewright.llm.bpe import Encoder
from minewright.session import cut
from tests.llm.reference_pii import base_spans

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = True
    return out


def test_chats_read_back(spark):
    tricky = ["", None, "plain", "a \\ b\\\\", "\\### Assistant: </turn> ok", "### user: x</turn>\n### assistant: y</turn>\n", "é\U0001F600\n\n#<\\h\\l", "x" * 100_000]
    draw = random.Random(2)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "a:b\\", None]), draw.choice(tricky)) for c in (*range(20), None) for t in range(draw.randint(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} #") for t in range(6000)]  # spans partitions
    rows += [(98, None, "user", "first"), (98, 0, "assistant", "same"), (98, 0, "assistant", "same")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string").repartition(4)
    found = {r.conv_id: r for r in chat.digests(cut(chat.format_chats(turns))).collect()}
    chats = defaultdict(list)
    for c, t, role, text in rows:
        chats[c].append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    assert set(found) == set(chats)
    for c, own in chats.items():
        own.sort()
        got, loss = found[c], "".join(o[5] for o in own if o[3] == "assistant")
        assert got.n_turns == len(own) and got.loss_chars == len(loss)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{o[3]}\n{o[5]}\n" for o in own).encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(cut(chat.format_chats(turns.limit(0)))).count() == 0


def test_bpe_equals_the_tokenizer(tokenizer):
    texts = ["it's a don't   we'll\n\n  x 've ''s 'sx I'm.", "  ", "", "a  b", "\xa0 x 　y\n z", "12ab 3\xbd \xb2x  _foo_ 'tis 's", " 's", "日本語 123", "a'", "x'll'd 'r 're'v",
             "<|endoftext|> hi \x1c\x1d b\x85c", "\xe9a \U0001F600 \U0001F600x", "tab\tword \tword\r\n\r\nend \n", None, "long" * 5000]
    draw = random.Random(4)
    texts += ["".join(draw.choice("ab Z\xe9\n\t '.,19€\xa0srelv") for _ in range(60)) for _ in range(300)]
    for remembered in (1_000_000, 40):  # also with a table that keeps forgetting
        got = []
        for _, ids, counts in Encoder(RANKS, remembered).encode(pa.array(texts)):
            ends = np.cumsum(counts)
            got += [ids[a:b].tolist() for a, b in zip(ends - counts, ends)]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_best_cuts_are_the_least():
    draw = random.Random(6)
    for _ in range(60):
        places = np.unique([0, *(draw.randint(1, 60) for _ in range(12)), 61])
        costs = np.array([draw.choice([0, 2, 12]) for _ in places])
        width = max(20, int(np.diff(places).max()))
        best = {0: 0.0}
        for j in range(1, len(places)):
            last = j == len(places) - 1
            best[j] = min(best[i] + (0 if last else costs[j] + width - places[j] + places[i]) for i in range(j) if places[j] - places[i] <= width)
        cuts = packing.best_cuts(places, costs, width)
        price = sum(costs[j] + width - places[j] + places[i] for i, j in zip(cuts[:-2], cuts[1:-1]))
        assert cuts[0] == 0 and cuts[-1] == len(places) - 1 and price == best[len(places) - 1]


def test_packing_holds_every_token_once(docs_of, odd_rows, tokenizer):
    rows = [(100 + k if id_ is None else id_, text) for k, (id_, text) in enumerate(odd_rows) if (id_, text) not in odd_rows[:k]]
    pieces = packing.pack(docs_of(rows), RANKS).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length > 0
    assert set(by_doc) == {i for i, _ in rows}
    for id_, text in rows:
        own = sorted(by_doc[id_], key=lambda p: p.start)
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == ids
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and {p.doc_tokens for p in own} == {len(ids)}
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        size = sum(p.length for p in own)
        assert size <= 1024
        padding += 0 if size & (size - 1) == 0 else 1024 - size
    assert padding < 0.02 * sum(p.length for p in pieces)
    assert packing.pack(docs_of([]), RANKS).count() == 0


def test_mixing_targets_and_draws(docs_of):
    draw = random.Random(8)
    rows = [(k, " ".join(["w"] * int(draw.paretovariate(0.8) * 3 % 4000)), draw.choice(["a", "b", "c", "d", "", None] if k % 3 else ["a"]), "en") for k in range(3000)]
    rows += [(None, "x y z", "tiny", "en"), (5000, None, "e", "en"), (5001, "solo", "f", "en"), (5001, "solo", "f", "en")]
    found = mixing.mix(docs_of(rows)).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        share = (sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    target |= {s: weight[s] * share for s in free}
    by_size = defaultdict(list)
    for r in found:
        by_size[r.source_size, round(r.target, 6)].append(r)
    assert set(by_size) == {(sizes[s], round(target[s], 6)) for s in order}
    for (words, aim), own in by_size.items():
        longest = max(r.size for r in own)
        assert abs(sum(r.taken for r in own) - aim * (len([s for s in order if (sizes[s], round(target[s], 6)) == (words, aim)]))) <= 2 * longest
        assert all(r.taken == r.copies * r.size <= 3 * r.size for r in own)
    again = mixing.mix(docs_of(rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    taken = mixing.mixture(docs_of(rows))
    assert taken.columns == docs_of(rows).columns and taken.count() == sum(r.copies for r in found if r.copies)
    assert mixing.mix(docs_of([])).count() == 0
    assert {r.taken for r in mixing.mix(docs_of([(1, None, "a", "en"), (2, " ", None, "en")])).collect()} == {0}


def test_pareto_sample_meets_its_chances(docs_of):
    """Over many seeds a document is drawn about as often as its inclusion probability says."""
    rows = [(k, " ".join(["w"] * (1 + 7 * k)), "a", "en") for k in range(12)] + [(100 + k, "w " * 40, "b", "en") for k in range(40)]
    counts, runs = defaultdict(int), 12
    for seed in range(runs):
        for r in mixing.mix(docs_of(rows), seed=seed).collect():
            counts[r.doc_id] += r.copies
    longer, shorter = sum(counts[k] for k in range(6, 12)), sum(counts[k] for k in range(6))
    assert longer >= shorter and all(counts[100 + k] <= 3 * runs for k in range(40))


def brute_fingerprint(spark, texts):
    from pyspark.sql import functions as F

    terms = {}
    for name, text in texts.items():
        w = [x for x in re.split("[ \t-\r]+", (text or "").lower()) if x]
        terms[name] = [w[i:i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
    flat = sorted({tuple((*t, None, None)[:3]) for own in terms.values() for t in own}, key=str)
    rows = spark.createDataFrame([(*t,) for t in flat] or [("", "", "")], "a string, b string, c string").withColumn("h", F.xxhash64("a", "b", "c"))
    hashes = {(r.a, r.b, r.c): (r.h, r.h2) for r in rows.withColumn("h2", F.xxhash64("h", F.lit(3))).collect()}
    out = {}
    for name, own in terms.items():
        bits = 0
        for half in (0, 1):
            total = sum(len(t[0].encode()) for t in own)
            for i in range(64):
                ones = sum(len(t[0].encode()) for t in own if hashes[tuple((*t, None, None)[:3])][half] >> i & 1)
                bits |= (2 * ones > total) << (i + 64 * (1 - half))
        out[name] = f"{bits:032x}"
    return out


def test_fingerprints(spark, docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] != 5] + [(5, "one TWO three four five six.")]
    found = simhash.edited_and_next(docs_of(rows)).collect()
    ids = sorted((i for i, _ in rows if i is not None), reverse=True)
    texts = {i: t or "" for i, t in rows if i is not None}
    want = brute_fingerprint(spark, texts)
    for r in (r for r in found if r.doc_id is not None):
        assert r.fingerprint == want[r.doc_id] and r.n_chars == len(texts[r.doc_id])
        at = ids.index(r.doc_id) + 1
        if at < len(ids):
            text, after = texts[r.doc_id], texts[ids[at]]
            edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.near_next == 1 - bin(int(r.fingerprint, 16) ^ int(want[ids[at]], 16)).count("1") / 128
    assert len(found) == len(rows) and simhash.edited_and_next(docs_of([])).count() == 0
    assert simhash.edited_and_next(docs_of([(1, "only one text here")])).first().near_next == 1.0


def test_block_tables_find_all_within_the_radius(spark):
    draw = random.Random(9)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = []
    for _ in range(40):
        base = draw.getrandbits(128)
        for _ in range(8):
            x = base
            for bit in draw.sample(range(128), draw.randint(0, 5)):
                x ^= 1 << bit
            prints.append(x)
    rows = [(k, signed(x >> 64), signed(x & (1 << 64) - 1)) for k, x in enumerate(prints)] + [(999, None, None)]
    table = spark.createDataFrame(rows, "id long, high long, low long")
    for radius in (0, 3, 6):
        found = {tuple(r) for r in simhash.within(table.where("id % 20 = 0"), table, radius).collect()}
        assert found == {(a, b, d) for a in range(0, len(prints), 20) for b in range(len(prints)) if (d := bin(prints[a] ^ prints[b]).count("1")) <= radius}


def test_personal_data_base_spans_and_more(docs_of):
    texts = ["", None, "a@b.c_d@e.f.g", "x@y.z. 1.2.3.4.5.6.7.8 256.1.1.1 +49 (0) 30 123456-", "4111 1111 1111 1111 and 4111111111111112", "é\u0001 a@b.co \u0001 +1+1+12 345 678 90123",
             "9" * 50_000 + " " + "a" * 200_000 + "@", "0 " * 30_000, "call me at (555) 123-4567 or bob [at] example [dot] com, ssn 123-45-6789", "version 1.2.3.4 total 300.1.1.1", "iban DE89 3704 0044 0532 0130 00."]
    draw = random.Random(12)
    texts += ["".join(draw.choice("a1.2@+- ()9_%é\n") for _ in range(draw.randint(1, 80))) for _ in range(300)]
    found = {r.doc_id: r for r in pii.personal_data(docs_of(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        base = base_spans(text or "")
        assert found[k].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (k, text)
        assert set(base) <= set(found[k].spans.split(",")) and found[k].n_phone == sum(s.startswith("phone") for s in base)
        assert found[k].n_added == len([s for s in found[k].spans.split(",") if s]) - len(base)
    assert {"id:56:67", "email:29:54"} <= set(found[8].spans.split(",")) or found[8].n_added >= 1
    assert pii.personal_data(docs_of([])).count() == 0


def test_em_finds_the_reliable_labelers():
    draw = random.Random(3)
    counts = defaultdict(int)
    for _ in range(4000):
        true = draw.random() < 0.4
        vote = lambda right: (1 if true else -1) if draw.random() < right else (-1 if true else 1)
        counts[vote(0.95), vote(0.9), vote(0.55), 0, vote(0.8)] += 1
    share, tables = pii.reliabilities(sorted(counts.items()))
    assert abs(share - 0.4) < 0.05
    right = [t[1][0] for t in tables]
    assert right[0] > 0.9 > right[4] > 0.7 > right[2]


def test_crc_of_pieces_is_that_of_the_ids(docs_of, tokenizer):
    from pyspark.sql import functions as F

    row = packing.pack(docs_of([(1, "hello")]), RANKS).select(F.crc32("ids").alias("crc")).first()
    assert row.crc == zlib.crc32(np.array([*tokenizer.encode("hello", add_special_tokens=False).ids, 0], "<u4").tobytes())
