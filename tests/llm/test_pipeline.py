import corpus_pipeline
import public_tokenizers as public
from tokenizers import Tokenizer

from strataflow.llm.toxicity import toxicity

from .test_exact_dedup import brute as exact
from .test_simhash import brute as linked
from .test_simhash import plain_fingerprint
from .test_tokenizers import crc, in_order

SF = "/root/testdata/sf0.001"


def cut(rows, length):
    """Texts without the bytes that a repeated string of ``length`` bytes covers."""
    texts = [text.encode() for _, text in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = set()
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        out.append((doc, bytes(b for i, b in enumerate(t) if i not in gone).decode("utf-8", "ignore")))
    return out


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r["doc_id"] for r in toxicity(docs, labels).collect() if r["predicted"]}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in bad]
    kept = {r[0] for r in exact(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    least = linked([(d, plain_fingerprint(t)) for d, t in rows])
    rows = [r for r, c in zip(rows, least) if r[0] == c]
    rows = cut(rows, 200)
    tokenizer = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            own = ids[s : s + 4096]
            want.append((doc, k, s, len(own), crc(own)))
    got = corpus_pipeline.run(spark, SF).collect()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert in_order(tuple(r[c] for c in columns) for r in got) == in_order(want)


def test_stages_keep_the_columns(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema], name
            assert after.count() <= docs.count()
            docs = after
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_clean_documents_stay(spark):
    """Different texts go through every filter, whatever their ids."""
    texts = [" ".join(f"w{k * 7 + n * k}" for n in range(30)) for k in range(1, 40)]
    rows = [(k if k % 5 else None, t, k) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, SF)
    assert docs.count() == len(rows)


def test_cutting_keeps_nulls_and_counts(spark):
    text = "".join(chr(97 + k * k % 23) + chr(97 + k * 7 % 19) for k in range(150))
    rows = [(1, None, 7, "x"), (2, text + " one", 9, "y"), (3, "two! " + text, 9, None), (4, "é", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, kept string")
    cut = dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, docs, SF)
    assert cut.columns == docs.columns and cut.schema["n_chars"] == docs.schema["n_chars"]
    found = {r["doc_id"]: (r["text"], r["n_chars"], r["kept"]) for r in cut.collect()}
    assert found == {1: (None, 7, "x"), 2: (" one", 4, "y"), 3: ("two! ", 5, None), 4: ("é", 1, "z")}


def test_repeated_rows_keep_their_text_once(spark):
    """A row that came twice, rows without ids, and texts of one id, through all filters and the cut."""
    def text(word):
        return " ".join(f"{word}{k * k % 97}{word}" for k in range(60))

    near = text("ab").upper()
    rows = [
        (1, text("xy"), "a"), (1, text("xy"), "a"), (1, text("xy").replace(" ", "  "), "b"),
        (None, text("pq"), None), (None, text("pq"), "c"), (None, text("pq"), "c"),
        (7, text("ab"), "d"), (7, near, "e"), (7, near, "e"), (8, near, "f"), (9, "short", "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    copies = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF)
    assert sorted(str(r["doc_id"]) for r in copies.collect()) == ["1", "7", "7", "9", "None"]
    lone = dict(corpus_pipeline.STAGES)["simhash"](spark, docs, SF)
    assert sorted(str(r["doc_id"]) for r in lone.collect()) == ["1", "7", "9", "None"]
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, SF)
    found = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert docs.count() == len(found) == 4
    assert " ".join(found[1].split()) == text("xy") and len(found[1]) > 200
    assert found[None] == text("pq") and found[7] in (text("ab"), near) and found[9] == "short"
