import random

import pytest

from signalloom.llm.common import read_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def odd_texts(rng):
    """Null, empty, very long, repeated and hostile texts."""
    alphabet = "01234567 -.+()@a_b%Z\n\u0001éß'\"<|>:="
    words = ["alpha", "beta", "Gamma", "delta", "x1", "the", "TOKEN=abcdefghijklmnop", "ünï", "a@b.cd", "4111111111111111"]
    texts = [None, "", None, "", " ", "\n", "one", "two words", "a" * 5000, "ab " * 20000, "1 " * 3000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.choice([10, 40, 300]))) for _ in range(60)]
    base = [rng.choice(words) for _ in range(400)]
    for k in range(12):
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = f"edit{rng.random()}"
        texts.append(" ".join(copy))
    texts += [" ".join(base)] * 5 + [" ".join(base).upper()] + ["<|endoftext|> ΟΔΟΣ ½ \u0085x"]
    return texts


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Ids in mixed order, columns with clashing names."""
    rows = [(3 * i if i % 2 else 1000 - i, t, "en", "src0", 7, i, i) for i, t in enumerate(odd_texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, `start` int"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def documents(spark):
    return read_table(spark, SF_DIR, "documents")


@pytest.fixture(scope="session")
def pairs(documents, odd_docs):
    """The same documents as lists of (doc_id, text)."""
    return {
        "documents": [(r[0], r[1]) for r in documents.select("doc_id", "text").collect()],
        "odd": [(r[0], r[1]) for r in odd_docs.select("doc_id", "text").collect()],
    }


@pytest.fixture(scope="session")
def empty_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(params=["documents", "odd"])
def case(request, documents, odd_docs, pairs):
    return {"documents": documents, "odd": odd_docs}[request.param], pairs[request.param]
