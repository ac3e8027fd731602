"""A table's further columns, named like the operators' own working columns, change nothing."""

import pytest

from orderloom.llm.queries import queries

EXTRA = (
    "block word n c size shard slot law text_crc32 held_out n_tokens score print component_id piece phrase rank "
    "spans found hash kind start end _row _owner _repository _base _mixed _slot _part _key live shaped"
).split()


@pytest.mark.parametrize(
    "name",
    ["op5_context_mixing", "op6_secrets", "op7_simhash", "op8_token_counts", "op9_sharding", "op12_personal_data", "op13_collocations"],
)
def test_further_columns_change_nothing(spark, documents, folder, tmp_path, name):
    texts = [f"w{k % 4} and so on, w{k % 3} mail a{k}@b.org token=abcdef0123456789{k % 5} end" for k in range(30)]
    rows = [*enumerate(texts), *enumerate(["common words go here"] * 110, 100), (900, None), (901, "")]
    plain = documents(*rows)
    query = queries()[name]
    expected = sorted(map(str, query(spark, folder(documents=plain)).collect()))
    clashing = plain.selectExpr("*", *(f"'x' as `{extra}`" for extra in EXTRA))
    clashing.write.parquet(str(tmp_path / "clashing" / "documents.parquet"))
    got = query(spark, str(tmp_path / "clashing"))
    assert sorted(map(str, got.collect())) == expected and expected
