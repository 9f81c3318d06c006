"""Words of the near-duplicate query and of its SQL end at the same characters."""

import duckdb
import pandas as pd

from stargrain.llm import near_dedup, queries


def test_every_white_space_of_the_contract_ends_a_word(spark):
    words = [f"w{i}" for i in range(12)]
    # The last two are no white space here, so these texts are one word.
    marks = [" ", "\t", "\n", "\x0b", "\x0c", "\r", " \r\n\x0b ", "\u00a0", "\x1f"]
    texts = [mark.join(words) for mark in marks] + ["A\x0bB\x0cC\rD", "a b c d", "\x0b\x0c", "", None]
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    db = duckdb.connect()
    db.register("documents", docs)
    answer = db.execute(queries.ORACLE["op6_minhash_near_dedup"])
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    want = sorted(tuple(row) for row in answer.df()[columns].itertuples(index=False))
    rows = [(i, text) for i, text in enumerate(texts)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4, threshold=80)
    got = sorted(tuple(r) for r in found.select(*columns).collect())
    assert got == want
    assert [r[2] for r in got] == [0] * 7 + [7, 8, 9, 9, 11, 12, 13]
    assert [r[1] for r in got] == [9] * 7 + [1, 1, 1, 1, 0, 0, 0]
