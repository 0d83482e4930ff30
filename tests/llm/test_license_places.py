"""op3_licenses gives the smallest and the largest start of a base phrase."""

from stratiform.llm.queries import op3_licenses


def test_places_are_starts(spark, scratch):
    folder = scratch("licenses")
    rows = [(1, "Released under the MIT License. Some words follow here"), (2, "a general public license"),
            (3, "mit license and the general public license or the apache license"), (4, "no phrase"), (5, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    out = op3_licenses(spark, folder)
    assert out.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert {r.doc_id: (r.first_word, r.last_word) for r in out.collect()} == {
        1: (3, 3), 2: (1, 1), 3: (0, 9), 4: (None, None), 5: (None, None)}
