"""Documents that equal or end in items of fewer words than a window."""

from lodegrain.llm import decontamination


def test_short_items_at_the_end_of_documents(spark):
    words = lambda n, tag: " ".join(f"{tag}{i}" for i in range(n))
    twelve = words(12, "t")
    items = spark.createDataFrame([(1, "one short item"), (2, twelve), (3, words(15, "l"))], "item_id long, text string")
    docs = [(0, "one short item"), (1, f"{words(8, 'a')} {twelve}"), (2, f"{words(9, 'a')} one short item"), (3, f"{words(238, 'a')} {twelve}"), (4, words(13, "l")), (5, f"{words(229, 'a')} {twelve}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for rows in (decontamination.WINDOW_BYTES, -1):
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in decontamination.report(df, items, broadcast_bytes=rows).collect()}
        assert got == {0: (3, 3, True), 1: (20, 12, True), 2: (12, 3, True), 3: (250, 12, False), 4: (13, 13, True), 5: (241, 12, False)}
