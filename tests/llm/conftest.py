import pytest

# Names that operators use inside, as columns that must not disturb them.
CLASHES = {"score": 0.5, "n_words": 7, "component_id": "x", "kept": "y", "others": "z", "row": 1, "count": 2, "spans": "s",
           "_text": "t", "_id": 3, "task": 4, "length": 5, "rank": 6, "label": 9}

LONG = " ".join(f"word{i % 5003}x{i}" for i in range(60_000))
PROSE = " ".join(f"The quick fox number {i} jumps over the lazy dog again." for i in range(12))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, equal rows, ties and clashing columns."""
    rows = [
        (1, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, "one"), (8, "one"), (None, PROSE),
        (9, "a b c"), (9, "a b c"), (10, "%%% ### !!!"), (11, PROSE.upper()), (None, None), (12, LONG + " tail"), (13, "12 34"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{name}` {'string' if isinstance(value, str) else 'double' if isinstance(value, float) else 'int'}"
        for name, value in CLASHES.items()
    )
    data = [(i, t, "en" if t else None, None, len(t) if t else None, *CLASHES.values()) for i, t in rows]
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
