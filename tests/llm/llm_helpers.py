"""Helpers of the corpus operators' tests."""

SF_SMALL = "/root/testdata/sf0.001"


def texts_of(df):
    """doc_id -> text of a table without repeated ids, null as empty."""
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


def write(spark, df, tmp_path):
    path = str(tmp_path / "documents.parquet")
    df.write.mode("overwrite").parquet(path)
    return path
