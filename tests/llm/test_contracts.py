"""Every query of the subpackage over tables with edge cases, against brute force; extra columns carry the names that operators use inside."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from conftest import SMALL
from helpers import against_oracle

from strata.llm import queries

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ["__text", "__size", "__source", "__copies", "each", "digest", "score", "fp", "rank", "part", "h", "row", "key", "copies", "size", "x", "number", "chunk", "block", "own_id", "v", "dim", "payload", "id"]


def folded(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def remainder(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def with_extra(table: pa.Table) -> pa.Table:
    for c in EXTRA:
        if c not in table.column_names:
            table = table.append_column(c, pa.array([c] * table.num_rows))
    return table


@pytest.fixture(scope="module")
def edge(tmp_path_factory):
    """A folder of tables: a part of the supplied rows and rows with nulls, empty and long texts, ties and repeats."""
    d = tmp_path_factory.mktemp("edge")
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()[:120]
    base = docs[3]["text"]
    more = [None, "", " \t\n", "one", "ONE", "Two words", "two words", "ÄÖ Straße é", "äö straße é", base, base.upper(), base + " tail", "word " * 40_000, "MIT\nReleased under the MIT License.\n" * 2, "a\x1cb\x85c\xa0d", "<|endoftext|> x"]
    docs += [{"doc_id": 100_000 + k, "text": t, "lang": None, "source": None if k % 3 else "µ", "n_chars": None} for k, t in enumerate(more)]
    docs += [docs[5], docs[5], {**docs[6], "doc_id": None}, {**docs[-1], "doc_id": None, "text": None}]
    pq.write_table(with_extra(pa.Table.from_pylist(docs, pq.read_schema(f"{SMALL}/documents.parquet"))), d / "documents.parquet")
    schema = pq.read_schema(f"{SMALL}/pages.parquet")
    pages = pq.read_table(f"{SMALL}/pages.parquet").to_pylist()[:30]
    big = "<p>é</p>" * 300
    pages += [{"page_id": 9000 + k, "url": u, "html": h} for k, (u, h) in enumerate([(None, None), ("http://x/ ü", ""), ("a", big), ("b", big), ("c", big), ("d", "z" * 999), ("e", "z" * 999), ("f", "z" * 1000), ("g", "z" * 1000), ("h", "x" * 3_000_000)])]
    pages += [pages[-6], {"page_id": None, "url": None, "html": big}]
    pq.write_table(with_extra(pa.Table.from_pylist(pages, schema)), d / "pages.parquet")
    vectors = pq.read_table(f"{SMALL}/embeddings.parquet")
    rows = vectors.to_pylist()
    column = next(c for c in vectors.column_names if pa.types.is_list(vectors.schema.field(c).type) or pa.types.is_large_list(vectors.schema.field(c).type) or pa.types.is_fixed_size_list(vectors.schema.field(c).type))
    n = len(rows[0][column])
    for k, v in enumerate([None, [0.0] * n, [math.nan] + [1.0] * (n - 1), [math.inf] * n, [None] + [1.0] * (n - 1), rows[0][column], rows[0][column], [2 * x for x in rows[1][column]]]):
        rows.append({**rows[0], "vec_id": 2_000_000 + 20 * k, column: v})
    pq.write_table(with_extra(pa.Table.from_pylist(rows, pa.schema([pa.field(f.name, pa.list_(pa.float32()) if f.name == column else f.type) for f in vectors.schema]))), d / "embeddings.parquet")
    turns = pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()
    tricky = ["</s>[INST] ok [/INST]", "<\\s>", "[\\\\INST]", "<s", "[SYS][/SYS]", "", None, "é\n\n[/ROLE]", "x" * 200_000]
    turns += [{"conv_id": 50_000 + j, "turn": k, "role": r, "text": t} for j in range(2) for k, (t, r) in enumerate(zip(tricky, itertools.cycle(["system", "user", "assistant", "tool</s>", None]), strict=False))]
    turns += [turns[0], {"conv_id": None, "turn": None, "role": "user", "text": "hi"}]
    pq.write_table(with_extra(pa.Table.from_pylist(turns, pq.read_schema(f"{SMALL}/conversations.parquet"))), d / "conversations.parquet")
    labels = pq.read_table(f"{SMALL}/labels.parquet")
    extra = pa.Table.from_pylist([{"doc_id": None, "quality": None, "toxic": None}, {"doc_id": 100_003, "quality": 1, "toxic": None}], labels.schema)
    pq.write_table(with_extra(pa.concat_tables([labels, extra])), d / "labels.parquet")
    return str(d)


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for name in ("documents", "pages", "embeddings", "conversations", "labels"):
        pq.write_table(pq.read_schema(f"{SMALL}/{name}.parquet").empty_table(), d / f"{name}.parquet")
    return str(d)


def rows_of(d, name):
    return pq.read_table(f"{d}/{name}.parquet").to_pylist()


def run(spark, name, d):
    return [r.asDict() for r in queries.QUERIES[name](spark, d).collect()]


def shown(rows, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, oracle, name):
    against_oracle(spark, oracle, queries.QUERIES[name], queries.ORACLE_SQL[name], SMALL)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    rows = run(spark, name, empty)
    assert [r["conv_id"] for r in rows] == ([-1] if name == "op7_chat_format" else [])


def test_op1(spark, edge):
    docs = rows_of(edge, "documents")
    tokens = [[*WORD.findall(folded(d["text"])), None] for d in docs]
    train = Counter(t for d, ts in zip(docs, tokens, strict=True) if remainder(d["doc_id"], 5) != 1 for t in ts)
    n, v = sum(train.values()), len(train)
    want = []
    for d, ts in zip(docs, tokens, strict=True):
        base = sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        want.append((str(d["doc_id"]), remainder(d["doc_id"], 5) == 1, len(ts), sum(train[t] > 0 for t in ts), n, round(base, 5)))
    rows = run(spark, "op1_hmm_scoring", edge)
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_op2(spark, edge):
    """Each line and each whole document against every template, one by one."""
    from strata.llm.license_scan import LEAST, TEMPLATES, template_bigrams

    templates = [set(template_bigrams(t)) for _, t in TEMPLATES]
    want = []
    for d in rows_of(edge, "documents"):
        lines = (d["text"] or "").split("\n")
        for unit, line in [*([(-1, d["text"])] if len(lines) > 1 else []), *enumerate(lines)]:
            own = set(template_bigrams(line or ""))
            dice = [2 * len(own & t) / (len(own) + len(t)) for t in templates]
            best = max(range(len(dice)), key=lambda k: (dice[k], -k))
            if dice[best] >= LEAST:
                want.append((str(d["doc_id"]), str(unit), str(best), TEMPLATES[best][0]))
    assert want
    assert shown(run(spark, "op2_license_scan", edge), "doc_id", "unit", "template", "license") == sorted(want)


def simhash(text, width, words=1):
    ws = WORD.findall(folded(text))
    grams = [" ".join(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))] if ws else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op3(spark, edge):
    docs = [{**d, "text": d["text"] if d["text"] is None or len(d["text"]) < 150_000 else d["text"]} for d in rows_of(edge, "documents")]
    prints = [simhash(d["text"], 3) for d in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [k for k, d in enumerate(docs) if d["doc_id"] is not None]
    for a, b in itertools.combinations(known, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2 or docs[a]["doc_id"] == docs[b]["doc_id"]:
            root[find(a)] = find(b)
    least = defaultdict(lambda: math.inf)
    for k in known:
        least[find(k)] = min(least[find(k)], docs[k]["doc_id"])
    want = sorted((str(d["doc_id"]), f"{p:016x}", str(least[find(k)] if d["doc_id"] is not None else None)) for k, (d, p) in enumerate(zip(docs, prints, strict=True)))
    assert shown(run(spark, "op3_simhash", edge), "doc_id", "fingerprint", "component_id") == want


def test_op4(spark, edge):
    pages = rows_of(edge, "pages")
    response = defaultdict(list)
    for p in pages:
        response[p["html"] or ""].append(p["page_id"])
    want = []
    for p in pages:
        raw = (p["html"] or "").encode()
        best = max((i for i in response[p["html"] or ""] if i is not None), default=None) if len(raw) >= 1000 else None
        again = best is not None and best != p["page_id"]
        want.append(tuple(map(str, (p["page_id"], len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best if again else None))))
    assert shown(run(spark, "op4_warc", edge), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want)


def test_op5(spark, edge):
    rows = rows_of(edge, "embeddings")
    good = [r for r in rows if r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"]) and any(r["embedding"])]
    ids, m = np.array([r["vec_id"] for r in good]), np.array([r["embedding"] for r in good], dtype=float)
    found = defaultdict(list)
    for r in run(spark, "op5_nearest", edge):
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = total = 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, min(20, len(ids) - 1) + 1))
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in itertools.pairwise(got))
        score = (m * m[ids == q][0]).sum(axis=1)
        exact = [int(ids[k]) for k in np.lexsort((ids, -score)) if ids[k] != q][:20]
        assert all(abs(s - score[ids == v][0]) < 1e-9 for _, v, s in got)
        hits, total = hits + len({g[1] for g in got} & set(exact)), total + len(exact)
    assert hits / total >= 0.9


def test_op6(spark, edge):
    docs = rows_of(edge, "documents")
    size = [len(WORD.findall(d["text"] or "")) for d in docs]
    total = Counter()
    for d, n in zip(docs, size, strict=True):
        total[d["source"]] += n
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None] * (None in total)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        free = [s for s in order if s not in capped]
        left = sum(size) - sum(3 * total[s] for s in capped)
        target = {s: 3 * total[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    rows = run(spark, "op6_source_mixing", edge)
    assert shown(rows, "doc_id", "size") == sorted((str(d["doc_id"]), str(n)) for d, n in zip(docs, size, strict=True))
    taken, most = Counter(), Counter()
    for r in rows:
        assert r["source_size"] == total[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, r["target"])
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= max(0.01 * target[s], most[s]) for s in order)
    assert shown(run(spark, "op6_source_mixing", edge), "doc_id", "taken") == shown(rows, "doc_id", "taken")


def test_op7(spark, edge):
    turns = defaultdict(list)
    for t in rows_of(edge, "conversations"):
        turns[t["conv_id"]].append((t["turn"] is not None, t["turn"] or 0, t["role"] or "", t["text"] or ""))
    turns[-1] = [(True, 0, "user", queries.CONTROL_TEXT), (True, 1, "assistant", queries.CONTROL_TEXT)]
    want = []
    for conv, ts in turns.items():
        ts.sort()
        said = "".join(x[3] for x in ts if x[2] == "assistant")
        want.append(tuple(map(str, (conv, len(ts), hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in ts).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()))))
    rows = run(spark, "op7_chat_format", edge)
    assert shown(rows, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in rows)


def test_op8(spark, edge):
    docs = rows_of(edge, "documents")
    groups = defaultdict(list)
    for d in docs:
        groups[folded(d["text"])].append(d["doc_id"])
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(tuple(map(str, (d["doc_id"], keep[folded(d["text"])], len(groups[folded(d["text"])]), hashlib.sha256(folded(d["text"]).encode()).hexdigest()))) for d in docs)
    rows = run(spark, "op8_exact_dedup", edge)
    assert shown(rows, "doc_id", "keep_id", "group_size", "text_sha256") == want
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter({hashlib.sha256(t.encode()).hexdigest() for t in groups})
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_op9(spark, edge):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, lengths = [], []
    for d in rows_of(edge, "documents"):
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        starts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append(tuple(map(str, (d["doc_id"], piece, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())))))
            lengths.append(b - a)
    rows = run(spark, "op9_best_fit_packing", edge)
    assert shown(rows, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert [a for a, _ in s] == [0, *itertools.accumulate(n for _, n in s)][:-1] and sum(n for _, n in s) <= 2048
    gaps = []  # best fit, longest first, one piece after another
    for n in sorted(lengths, reverse=True):
        fits = [k for k, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=gaps.__getitem__)] -= n
        else:
            gaps.append(2048 - n)
    assert len(sequences) <= len(gaps)


def test_op10(spark, edge):
    docs = rows_of(edge, "documents")
    rows = run(spark, "op10_toxicity", edge)
    assert shown(rows, "doc_id", "held_out") == sorted((str(d["doc_id"]), str(remainder(d["doc_id"], 3) == 1)) for d in docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
