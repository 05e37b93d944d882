import datetime as dt
import random

import pytest

#: Columns whose names clash with what the operators add.
CLASHES = {c: "x" for c in ("size", "slot", "shard", "score", "node", "ids", "copies", "bucket", "n_tokens", "component", "content", "spans")}


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "La", "der", "ein"] + [f"w{rng.randint(0, 400)}" for _ in range(4)]) for _ in range(n))


def edge_documents():
    """Null, empty, blank and very long texts, repeated rows, ties, null ids,
    near and exact copies, personal data."""
    rng = random.Random(7)
    base = words(rng, 120)
    texts = [None, "", " \t\n ", "one", "One ", "é漢😀 ß", "a" * 120_000, words(rng, 30_000), base, base, base + " more words here",
             base.replace("w", "W"), "Mail joe@x.org, call +1 (663) 555-6869 or 10.0.0.1; 4111 1111 1111 1111",
             "the of and", "\x0bx\x0cy", "tab\tsep\r\nline", "<|endoftext|> and <|startoftext|>", "it's we'll 123"]
    texts += [words(rng, rng.randint(1, 200)) for _ in range(30)]
    texts += [" ".join(w + "***" for w in words(rng, 40).split()) for _ in range(12)]
    rows = [(i * 3, t, "en", f"s{i % 4}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[8]] * 5 + [rows[0]] * 2 + [rows[1]]  # repeated rows
    rows += [(None, "no id at all here", None, None, None), (None, None, None, None, None), (24, "same id, other text", "en", "s1", None)]
    return rows


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_rows():
    return edge_documents()


def write_tables(spark, folder, documents, labels=(), pages=(), embeddings=(), extra=True):
    from pyspark.sql import functions as F

    def put(name, rows, schema, partitions=3):
        df = spark.createDataFrame(list(rows), schema)
        if extra:
            df = df.withColumns({c: F.lit(v) for c, v in CLASHES.items()})
        df.repartition(partitions).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")

    put("documents", documents, DOCUMENTS)
    put("labels", labels, "doc_id long, quality int, toxic int")
    put("pages", pages, "page_id long, url string, html string")
    put("embeddings", embeddings, "vec_id long, embedding array<float>, label int")
    return folder


@pytest.fixture(scope="session")
def edge_sf(spark, tmp_path_factory, edge_rows):
    labels = [(r[0], 0 if r[1] and "***" in r[1] else 1, 0) for r in edge_rows if r[0] is not None and r[1]] + [(3, None, 0), (None, 1, 0), (6, 1, 0), (6, 0, 0)]
    return write_tables(spark, str(tmp_path_factory.mktemp("edge")), edge_rows, labels)


@pytest.fixture(scope="session")
def empty_sf(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), [])


@pytest.fixture(scope="session")
def small_sf():
    return "/root/testdata/sf0.001"


def multiset(rows):
    return sorted(map(repr, rows))
