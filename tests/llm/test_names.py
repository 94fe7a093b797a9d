"""Every operator that returns its input's columns keeps them, whatever their names."""

from quarry.llm import op1_urls, op3_mix, op7_pii, op10_lang
from tests.llm import edge


def test_input_columns_stay(spark):
    docs = edge.taken(spark)
    assert edge.keeps_taken(docs, op3_mix.keep_sampled(docs, rounds=1))
    assert edge.keeps_taken(docs, op7_pii.pseudonymize(docs))
    assert edge.keeps_taken(docs, op10_lang.keep_identified(docs))
    pages = docs.withColumnRenamed("text", "url")
    rules = spark.createDataFrame(op1_urls.RULES, "verdict string, host string, path string")
    for limit in (1 << 20, 0):
        assert edge.keeps_taken(pages, op1_urls.url_filter(pages, rules, trie_bytes=limit))
