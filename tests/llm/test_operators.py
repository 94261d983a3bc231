"""Each operator on small fixtures: brute force, round trips, and tables with NULLs, ties,
repeated rows, empty and long texts, clashing columns, and no rows at all."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonal.llm import chat, decontaminate, importance, mixing, near_dup, quality_rules, sharding, token_files, url_lists, warc
from zonal.llm.common import in_order, look_up, new_folder, sift, spread_join
from zonal.llm.queries import tokenizer_path
from zonal.operators.staging import stage

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs everywhere, repeated rows, blank, empty and very long texts, a hot source, and columns
    that have the names the operators add."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = text(120)
    rows = [(i, text(rng.randint(1, 90)), "en", "hot" if i % 3 else f"s{i % 4}", 1) for i in range(60)]
    rows += [(100 + i, base.replace(base.split()[0], "changed", 1) if i else base, None, "hot", None) for i in range(5)]
    rows += [(200, None, None, None, None), (None, "a null id has words too", None, "hot", 0), (201, "", "", "", 0)]
    rows += [(202, " \t\n\x0b\x0c\r ", "x", "s1", 1), (203, "ok\n\nok\n ok", "x", "s1", 1), (203, "ok\n\nok\n ok", "x", "s1", 1)]
    rows += [(204, text(20_000), "x", "hot", 1), (205, "É é İ 🙂   x", "x", "s2", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit(7) for c in ("shard", "position", "row_id", "blocked", "n", "key", "size")}
    )


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def columns(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_look_up_and_spread_join_agree_with_plain_joins(spark):
    rows = stage(spark.range(5000).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), "id").withColumn("k", F.when(F.col("k") != 5, F.col("k"))))
    sizes = rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("v"))
    table = stage(sizes.where("k <> 2"))
    got = sorted(columns(look_up(rows, table, "k", 5000), "id", "v"))
    assert got == sorted(columns(rows.join(table.drop("n"), "k", "left"), "id", "v"))
    assert sorted(columns(look_up(rows, table, "k", 5000, written=True), "id", "v")) == got
    own = stage(spark.range(0, 5000, 3).select(F.col("id").alias("k"), F.lit(1).alias("n"), (F.col("id") * 2).alias("v")))
    plain = look_up(stage(spark.range(5000).select(F.col("id").alias("k"), "id")), own, "k", 5000, written=True)
    assert sorted(columns(plain, "id", "v")) == [(i, i * 2 if i % 3 == 0 else None) for i in range(5000)]
    spread = sorted(columns(spread_join(rows, table.drop("n"), "k", "id", 5000), "id", "v"))
    assert spread == sorted(columns(rows.join(table.drop("n"), "k"), "id", "v"))
    wanted = rows.where("id < 40")
    kept = {r[0] for r in columns(sift(rows, "id", wanted, 40), "id")}
    assert set(range(40)) <= kept and len(kept) < 1500
    assert [r[1] for r in sorted(columns(in_order(rows, "id"), "id", "position"))] == list(range(5000))


def test_mix_meets_targets(spark, odd, none):
    plan = mixing.plan_mix(odd, None).toPandas()
    text = {(i, t): len(WORD.findall(t or "")) for i, t in columns(odd, "doc_id", "text")}
    assert sorted(plan["size"]) == sorted(len(WORD.findall(t or "")) for _, t in columns(odd, "doc_id", "text")) and text
    sizes = collections.Counter()
    for s, t in columns(odd, "source", "text"):
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    caps, left, open_ = {s: 2 * sizes[s] for s in order}, 1.5 * sum(sizes.values()), set(order)
    want = {}
    while open_:  # hand out by weight, close what is full, again
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= caps[s]}
        for s in full or open_:
            want[s] = caps[s] if full else level * weights[s]
        left -= sum(want[s] for s in full or open_)
        open_ -= full or open_
    by_size = {sizes[s]: want[s] for s in order}
    for source_size, rows in plan.groupby("source_size"):
        assert rows["target"].iloc[0] == pytest.approx(by_size[source_size])
        assert abs(rows["taken"].sum() - rows["target"].iloc[0]) <= rows["size"].max() / 2 + 1e-9
    assert (plan["taken"] <= 2 * plan["size"]).all()
    again = mixing.plan_mix(odd, None).toPandas()
    key = ["doc_id", "size", "taken"]
    assert plan[key].sort_values(key).values.tolist().__str__() == again[key].sort_values(key).values.tolist().__str__()
    mixed = mixing.mix(odd)
    assert mixed.columns == [*odd.columns, "position_"]
    rows = mixed.toPandas()
    assert rows["position_"].is_monotonic_increasing and len(rows) == sum(len(p) for p in plan["positions"])
    assert mixing.plan_mix(none, None).count() == 0 and mixing.mix(none).count() == 0


def test_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 500 else "b") for i in range(1000)], "doc_id bigint, text string, source string")
    knots = [("a", 0.0, 2.0), ("a", 1.0, 0.0), ("b", 0.0, 0.0), ("b", 1.0, 2.0)]
    schedule = spark.createDataFrame(knots, "source string, at double, weight double")
    rows = mixing.mix(docs, schedule, share=1.0).select("source", "position").toPandas()
    for part in (0.25, 0.5, 0.75):
        early = rows[rows.position < part]
        assert (early.source == "a").sum() == pytest.approx(500 * (2 * part - part * part), abs=3)
        assert (early.source == "b").sum() == pytest.approx(500 * part * part, abs=3)


def test_token_files_round_trip(spark, odd, none):
    from tokenizers import Tokenizer

    folder = new_folder(spark, "tokens")
    token_files.write_tokens(odd, folder, tokenizer_path(), end_id=2, parts=3)
    got = [tuple(r) for r in token_files.read_documents(spark, folder).orderBy("start").collect()]
    plain = Tokenizer.from_file(tokenizer_path())
    left = collections.Counter()
    for i, t in columns(odd, "doc_id", "text"):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        left[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter((i, n, c) for i, _, n, c in got) == left
    ids = [i for i, *_ in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [s for _, s, _, _ in got] == [0, *np.cumsum([n for _, _, n, _ in got])[:-1].tolist()]
    empty = new_folder(spark, "tokens")
    assert token_files.write_tokens(none, empty, tokenizer_path(), 2)["docs"] == 0
    assert token_files.read_documents(spark, empty).count() == 0


def test_words_encode_as_whole_texts():
    words = token_files.Encoder(tokenizer_path(), True)
    whole = token_files.Encoder(tokenizer_path(), False)
    texts = ["", " ", "a  b", "a \nb", "a\n b", "\0b \0b b", "don't  ", "é é  x", "<|endoftext|> <|endoftext|>", "x " * 50 + "\t"]
    assert words.encode(texts) == whole.encode(texts) == words.encode(texts)


def test_plain_words_go_to_the_model_by_pieces():
    rng = random.Random(11)
    signs = "abZ09.,;:!?()-'$%&|<>*_\n\t éÀ×ɏЯ҂中ß½ 　`"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["\nfoo\n bar\n\nbaz \n q", "don't we'll 'tis", "a<|endoftext|>b c", " a", "a ", "x\n"]
    words, whole = token_files.Encoder(tokenizer_path(), True), token_files.Encoder(tokenizer_path(), False)
    assert words.encode(texts) == whole.encode(texts) == words.encode(texts)
    plain = ["Quite new, and (plain)\nwords; größer 42%"]
    want, words.tokenizer = whole.encode(plain), None
    words.ids = lambda left: [] if not left else pytest.fail(str(left))
    assert words.encode(plain) == want


def test_url_lists(spark):
    day = "cast(day as date) day"
    entries = spark.createDataFrame(
        [("bad.org", "2020-01-10", "block"), ("bad.org", "2020-03-05", "remove"), ("a.bad.org", "2020-02-01", "allow"),
         ("x.com/p", "2020-01-01", "block"), ("x.com/p", "2020-01-01", "remove"), (None, "2020-01-01", "block"), ("y", None, "block")],
        "address string, day string, action string",
    ).selectExpr("address", day, "action")
    captures = spark.createDataFrame(
        [("http://bad.org/1", "2020-01-09"), ("http://www.bad.org/1", "2020-01-10"), ("http://bad.org/1", "2020-03-05"), ("http://BAD.org./1", "2020-03-04"),
         ("http://b.a.bad.org/", "2020-02-02"), ("http://b.a.bad.org/", "2020-03-30"), ("https://u@x.com:8080/p?q#f", "2020-05-01"), ("https://x.com/q", "2020-05-01"),
         (None, "2020-05-01"), ("no url", "2020-05-01"), ("http://bad.org/", None), ("http://bad.org/1", "2020-03-04"), ("http://bad.org/1", "2020-03-04")],
        "url string, day string",
    ).selectExpr("url", day, "7 as blocked")
    got = sorted(columns(url_lists.judge(captures, entries), "url", "day", "blocked_", "decided_by", "active_entries"), key=str)
    got = collections.Counter((u, str(d), b, by, n) for u, d, b, by, n in got)
    assert got == collections.Counter([
        ("http://bad.org/1", "2020-01-09", False, None, 0), ("http://www.bad.org/1", "2020-01-10", True, "bad.org", 1),
        ("http://bad.org/1", "2020-03-05", False, None, 0), ("http://BAD.org./1", "2020-03-04", True, "bad.org", 1),
        ("http://b.a.bad.org/", "2020-02-02", False, "a.bad.org", 2), ("http://b.a.bad.org/", "2020-03-30", False, "a.bad.org", 1),
        ("https://u@x.com:8080/p?q#f", "2020-05-01", True, "x.com/p", 1), ("https://x.com/q", "2020-05-01", False, None, 0),
        (None, "2020-05-01", False, None, 0), ("no url", "2020-05-01", False, None, 0), ("http://bad.org/", "None", False, None, 0),
        ("http://bad.org/1", "2020-03-04", True, "bad.org", 1), ("http://bad.org/1", "2020-03-04", True, "bad.org", 1),
    ])
    assert url_lists.judge(captures.limit(0), entries).count() == 0
    assert {r[0] for r in columns(url_lists.judge(captures, entries.limit(0)), "blocked_")} == {False}


def test_importance_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen, held = labels.where("doc_id % 2 = 0"), {r[0]: r[1] for r in columns(labels.where("doc_id % 2 = 1"), "doc_id", "quality")}
    chosen, model = importance.resample(docs, seen)
    kept = {r[0] for r in columns(chosen, "doc_id")}
    right = sum((i in kept) == (q == 1) for i, q in held.items())
    assert right / len(held) >= 0.97
    assert kept == {r[0] for r in columns(importance.select(docs, model), "doc_id")}
    few, _ = importance.resample(docs, seen, k=10)
    assert sorted(r[0] for r in columns(few, "position")) == list(range(10))


def test_importance_on_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    chosen, model = importance.resample(odd, labels)
    assert importance.select(odd, model).columns == odd.columns
    assert not {200, 201, 202} & {r[0] for r in columns(chosen, "doc_id")}
    assert importance.resample(none, labels)[0].count() == 0
    unlabelled, _ = importance.resample(odd, labels.limit(0))
    assert unlabelled.count() == sum(bool(WORD.search(t or "")) for (t,) in columns(odd, "text"))


def test_chat_round_trip(spark):
    rows = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 1, "assistant", None),
            (1, 0, None, "hi"), (1, 2, "assistant", "é🙂\n <turn x>\\"), (2, None, "a>b\\", ""), (2, 3, "assistant", "x"), (2, 3, "assistant", "x"),
            (None, 0, "assistant", " spaced \n"), (3, 0, "assistant", "long " * 30_000)]
    chats = stage(chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), tokenizer_path()))
    got = {r["conv_id"]: r for r in chat.digest_chats(chats).collect()}
    held = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        held[conv].append((role or "", text or ""))
    assert set(got) == set(held)
    for conv, turns in held.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest() and got[conv]["loss_chars"] == len(learned)
        assert got[conv]["n_turns"] == len(turns)
    for row in chats.collect():
        assert len(row["tokens"]) == len(row["loss_mask"]) and chat.parse(row["formatted"]) == held[row["conv_id"]]
        assert any(row["loss_mask"]) == bool(row["loss_spans"])
    assert chat.format_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"), tokenizer_path()).count() == 0


def test_mask_holds_texts_and_nothing_else():
    conversations = [
        [("user", "hi"), ("assistant", "hello there"), ("assistant", "x")],
        [("a>b\\", "x\\"), ("assistant", "é🙂\n <turn x>\\"), ("assistant", "</turn>\n<turn assistant>")],
        [("assistant", " spaced \n"), ("assistant", ""), ("assistant", "\\\\</turn>\n"), ("assistant\\>", "<|endoftext|>")],
    ]
    for turns in conversations:
        formatted, spans = chat.render(turns)
        tokens = chat.encoder(tokenizer_path()).encode(formatted, add_special_tokens=False)
        starts, ends = np.array(tokens.offsets).T
        mask, under = chat.loss_of(spans, starts, ends, frozenset(["assistant"]))
        learned = [(a, b) for a, b, role in spans if role == "assistant"]
        assert all(any(a <= first and last <= b for a, b in learned) for first, last in zip(starts[mask == 1], ends[mask == 1]))
        assert [chat.unescape(formatted[a:b]) for a, b in under] == [t for role, t in turns if role == "assistant" and t]


def test_shards_are_exact_and_uniform(spark, odd, none):
    rows = sharding.shuffle_into_shards(odd, 7)
    assert rows.columns == [*odd.columns, "shard_", "slot"] and rows.count() == odd.count()
    slots = collections.defaultdict(list)
    for shard, slot in columns(rows, "shard_", "slot"):
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and len(sizes) == 7
    assert sharding.shuffle_into_shards(none, 7).count() == 0
    ids = stage(spark.range(6000).withColumnRenamed("id", "row"))
    one, other = (sorted(columns(sharding.place(ids, "row", 6, s), "row", "shard", "slot")) for s in (1, 9))
    assert one == sorted(columns(sharding.place(ids, "row", 6, 1), "row", "shard", "slot"))
    met = np.zeros((6, 6))
    for a, b in zip(one, other):
        met[a[1], b[1]] += 1
    assert ((met - 1000 / 6) ** 2 / (1000 / 6)).sum() < 60  # chi-square, 25 degrees of freedom


def test_hypergeometric_law():
    rng = np.random.Generator(np.random.Philox(3))
    drawn = [sharding.hypergeometric(rng, 30, 50, 20) for _ in range(4000)]
    assert np.mean(drawn) == pytest.approx(7.5, abs=0.1) and np.var(drawn) == pytest.approx(20 * 0.375 * 0.625 * 60 / 79, rel=0.1)
    big = [sharding.hypergeometric(rng, 10**12, 23 * 10**12, 10**8) for _ in range(200)]
    assert np.mean(big) == pytest.approx(10**8 / 24, rel=1e-3)
    matrix = np.array(sharding.communication_matrix([5, 0, 40, 3], [16, 16, 16], 1))
    assert matrix.sum(axis=0).tolist() == [16, 16, 16] and matrix.sum(axis=1).tolist() == [5, 0, 40, 3]


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, len(s), low.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def test_near_duplicates_by_brute_force(spark, odd, none):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(90)]
    rows = columns(odd, "doc_id", "text")
    for i in range(150):  # a crowd of edited copies, linked only through each other
        words = list(base)
        for k in rng.sample(range(90), rng.randint(0, 5)):
            words[k] = f"e{i}x{k}"
        rows.append((1000 + i, " ".join(words).upper() if i % 2 else " ".join(words)))
    rows += [(3000 + i, rows[0][1]) for i in range(30)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(columns(got, "doc_id", "n_shingles", "component_id"), key=str) == brute_components(rows)
    assert all(kept == (n == 0 or (i is not None and i == c)) for i, n, c, kept in columns(got, "doc_id", "n_shingles", "component_id", "kept"))
    assert near_dup.near_duplicates(none).count() == 0
    every = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), likely=0)
    assert sorted(columns(every, *every.columns), key=str) == sorted(columns(got, *got.columns) if hasattr(got, "columns") else got, key=str)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(400)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = dict(columns(near_dup.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(6)), "node", "group"))
    assert len({got[i] for i in range(401)}) == 1 and len({got[1000 + i] for i in range(300)}) == 1 and len(set(got.values())) == 2


def test_signatures_estimate_overlap():
    rng = np.random.Generator(np.random.Philox(5))
    pool = rng.integers(1, 1 << 62, 4000).astype("u8")
    pairs = [(pool[k * 100 : k * 100 + 400], pool[k * 100 + 50 : k * 100 + 450]) for k in range(30)]
    flat = [x for p in pairs for x in p]
    slots = near_dup.signatures(np.concatenate(flat), np.repeat(np.arange(60), 400), 60)
    agree = (slots[0::2] == slots[1::2]).mean(axis=1)
    assert agree.mean() == pytest.approx(350 / 450, abs=0.03) and agree.std() < 0.05


def test_warc_round_trip(spark, none):
    rows = [(3, "http://b.org/x?q=1#f", "<p>é</p>"), (1, "http://a.b.org/", "<p>é</p>"), (2, None, None), (9, "http://b.org/x?q=1", ""), (4, "odd\r\nurl", "long " * 50_000),
            (None, "http://b.org/n", "<p>é</p>"), (7, "http://b.org/r", "r"), (7, "http://b.org/r", "r")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = new_folder(spark, "warc")
    warc.write_warc(pages, folder, parts=3)
    read = warc.read_captures(spark, folder).collect()
    assert sorted(r["url"] for r in read) == sorted(u or "" for _, u, _ in rows)
    got = [tuple(v for n, v in r.asDict().items() if n != "url") for r in read]

    def want(page, html):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = min(i for i, _, h in rows if (h or "") == (html or "") and i is not None)
        return (page, len(data), digest, "response" if page == first else "revisit", None if page == first else first)

    assert sorted(got, key=str) == sorted((want(i, h) for i, _, h in rows), key=str)
    found = columns(warc.find_captures(spark.createDataFrame([("http://B.org/x?q=1",), ("http://nowhere.org/",), (None,)], "url string"), folder), "page_id")
    assert sorted(found) == [(3,), (9,)]
    empty = new_folder(spark, "warc")
    warc.write_warc(pages.limit(0), empty)
    assert warc.read_captures(spark, empty).count() == 0
    whole = new_folder(spark, "warc")
    warc.write_warc(pages, whole, least_bytes=5)
    assert {r[0] for r in columns(warc.read_captures(spark, whole).where("payload_bytes < 5"), "record_type")} == {"response"}


@pytest.mark.parametrize("url", ["", "http://a/b\n\r\\n\\", "a\\\\r\r\n\r\nWARC-Type: x"])
def test_any_url_survives_in_a_header(url):
    record = warc.parse_record(warc.warc_record(3, url, hashlib.sha1(b"p").hexdigest(), 1, False, None, b"p"))
    assert (record["url"], record["page_id"], record["payload"]) == (url, 3, b"p")


def test_quality_rules_by_brute_force(spark, odd, none):
    got = collections.Counter(
        columns(quality_rules.judge(odd, F.col("source")), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    )
    want = collections.Counter()
    for i, text in columns(odd, "doc_id", "text"):
        text = text or ""
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:]))
        often = collections.Counter(windows)
        covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want[i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed] += 1
    assert got == want
    assert quality_rules.judge(none, F.col("source")).count() == 0


def test_hosts_are_shrunk_towards_the_mean(spark):
    hosts = spark.createDataFrame([(f"h{k}", 1000, 100 + 10 * k) for k in range(10)] + [("bad", 1000, 990), ("tiny", 1, 1)], "host string, n bigint, failures bigint")
    rate = dict(columns(quality_rules.host_rates(hosts), "host", "rate"))
    assert rate["bad"] > 0.9 and 0.1 < rate["tiny"] < 0.9 and abs(rate["h0"] - 0.1) < 0.02
    assert quality_rules.host_rates(hosts.limit(0)).count() == 0


def test_host_verdicts_by_brute_force(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "too short"
    hosts = {"fine": (60, 3), "awful": (40, 38), "tiny": (1, 1), None: (5, 2)}
    rows = [(host, bad if k < failed else good) for host, (n, failed) in hosts.items() for k in range(n)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, source string, text string")
    known = [(n, f) for host, (n, f) in hosts.items() if host]
    total, failed = sum(n for n, _ in known), sum(f for _, f in known)
    mean = failed / total
    between = sum(n * (f / n - mean) ** 2 for n, f in known) / (len(known) - 1)
    within = sum(f * (1 - f / n) for n, f in known) / (total - len(known))
    extra = (between - within) / ((total - sum(n * n for n, _ in known) / total) / (len(known) - 1))
    weight = min(1000.0, max(1.0, mean * (1 - mean) / extra - 1))
    rate = {host: (f + mean * weight) / (n + weight) for host, (n, f) in hosts.items() if host}
    assert rate["fine"] < 0.5 < rate["awful"]
    judged = {r["doc_id"]: r for r in quality_rules.judge(docs, F.col("source")).collect()}
    for i, (host, text) in enumerate(rows):
        assert judged[i]["kept"] == (text == good and rate.get(host, 0) <= 0.5), (host, text)
        assert judged[i]["host_rate"] == (None if host is None else pytest.approx(rate[host]))


def test_leaks_of_edited_copies(spark, odd, none):
    item = "What is the capital of the old northern kingdom that traded amber and furs with the river towns?"
    items = spark.createDataFrame([(1, item), (2, None), (3, "ab"), (4, "")], "item_id bigint, text string")
    edited = "what was the capital of this old kingdom that traded amber, and furs, with the many river towns"
    rows = [(500, f"so then {item} yes"), (501, "x " * 300 + edited.upper()), (502, "traded amber and furs with nobody"), (None, item)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = {(d, i): s for d, i, s in columns(decontaminate.find_leaks(docs, items), "doc_id", "item_id", "score")}
    assert set(found) == {(500, 1), (501, 1), (None, 1)} and found[500, 1] == 1.0 and found[501, 1] < 1
    clean = decontaminate.without_leaks(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert decontaminate.find_leaks(none, items).count() == 0 and decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_alignment_by_plain_dynamic_programming():
    rng = np.random.Generator(np.random.Philox(2))
    for _ in range(40):
        x, y = rng.integers(0, 4, rng.integers(1, 30)), rng.integers(0, 4, rng.integers(1, 12))
        table = np.zeros((len(y) + 1, len(x) + 1), dtype=int)
        for i in range(len(y)):
            for j in range(len(x)):
                match = table[i, j] + (2 if y[i] == x[j] else -1)
                table[i + 1, j + 1] = max(0, match, table[i, j + 1] - 1, table[i + 1, j] - 1)
        assert decontaminate.align(x, y)[0] == table.max()


def test_passages_start_where_their_alignment_does():
    item = np.arange(100, 120)
    copy = np.concatenate([item[:5], [1, 2], item[5:12], [3], item[12:]])
    assert decontaminate.align(np.concatenate([[7] * 9, copy, [8] * 4]), item) == (2 * 20 - 3, 9, 9 + len(copy))
    rng = np.random.Generator(np.random.Philox(4))
    for _ in range(60):
        x, y = rng.integers(0, 4, rng.integers(1, 30)), rng.integers(0, 4, rng.integers(1, 12))
        score, first, last = decontaminate.align(x, y)
        # the passage alone scores the same, and begins with a word of the item
        assert decontaminate.align(x[first:last], y)[0] == score
        assert not score or x[first] in y


def test_rows_without_gone_keys(spark):
    from zonal.llm.common import without

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (5, "e")], "k bigint, v string")
    gone = spark.createDataFrame([(2,), (9,)], "k bigint")
    assert sorted(r.v for r in without(rows, "k", gone, 2).collect()) == ["a", "d", "e"]
    assert without(rows, "k", gone.limit(0), 0).count() == 5
    assert without(rows.limit(0), "k", gone, 2).count() == 0
