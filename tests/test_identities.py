import itertools
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import identities
from orderloom.operators.guards import GuardError
from orderloom.operators.numbering import last_sequence, number_rows
from orderloom.operators.repeats import line_sequence, repeated_rows
from orderloom.session import materialize
from orderloom.spec import PRODUCT_MAPPING_SCHEMA

PRODUCT = "full_sku_code first_half_sku_code unique_sku_code product_description product_category"


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def product(sku, category, description=None):
    half, unique = sku.split("-")
    return (sku, half, unique, description or f"d{sku}", category)


@pytest.fixture
def categories(values):
    return values(
        "product_category pseudo_category", ("RINGS", "Small Ring"), ("STONES", "Standard Rock"),
        ("AXES", "Sharp Razor"), ("OILS", "Oil"),
    )


def test_numbering_is_exact_with_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 50 == 1, F.lit("b")).otherwise(F.lit("hot")).alias("g"),
        F.format_string("%05d", F.hash("id") % 100000).alias("o"), "id",
    )
    out = number_rows(df, ["o", "id"], ["g"], "n").collect()
    for group in (None, "b", "hot"):
        members = sorted((r for r in out if r.g == group), key=lambda r: (r.o, r.id))
        assert [r.n for r in members] == list(range(1, len(members) + 1))
    whole = number_rows(df.select("o", "id"), ["o", "id"], name="n").collect()
    assert [r.n for r in sorted(whole, key=lambda r: (r.o, r.id))] == list(range(1, 3001))


def test_sequences_tolerant_and_strict(values):
    some = values("c", ("A-0009",), ("edited",), (None,))
    assert last_sequence(some, "c").first()[0] == 9
    with pytest.raises(Exception, match="No sequence number"):
        last_sequence(some, "c", strict=True).collect()
    with pytest.raises(Exception, match="No sequence number"):
        last_sequence(values("c", ("edited",)), "c").collect()
    assert last_sequence(some.where("false"), "c").first()[0] == 0


def test_customers_stay_stable_over_three_runs(values):
    names = "source_customer_code ship_to_customer_code customer_name"
    runs = [values(names, *((str(k), "1", f"c{k}") for k in keys)) for keys in ((5, 6), (1, 2, 5), (6, 9))]
    mapping, seen = None, {}
    for orders in runs:
        mapping = materialize(identities.map_customers(identities.customer_profile(orders), mapping), "t")
        now = dict(rows(mapping, "customer_hash_key", "pseudo_customer_name"))
        assert seen.items() <= now.items()
        assert len(set(now.values())) == len(now)
        seen = now
    assert sorted(seen.values()) == [f"Customer CUST-{k:06d}" for k in range(1, 6)]


def test_identity_is_normalized_and_null_fails(values):
    names = "source_customer_code ship_to_customer_code customer_name"
    df = values(names, ("1", "2", " Acme\t"), ("1 ", "2", "ACME"))
    assert identities.customer_profile(df).count() == 1
    with pytest.raises(Exception, match="Null customer identity"):
        identities.customer_profile(values(names, ("1", None, "x"))).collect()


def test_routes_skip_null_and_continue(values):
    first = identities.map_routes(identities.route_profile(values("delivery_route_name", ("m",), (" m ",), (None,))), None)
    assert rows(first, "*") == {("m", "Route RT-000001")}
    second = identities.map_routes(identities.route_profile(values("delivery_route_name", ("a",), ("m",))), first)
    assert rows(second, "*") == {("m", "Route RT-000001"), ("a", "Route RT-000002")}


def build(values, categories, existing, *products):
    profile = values(PRODUCT, *products)
    return materialize(identities.build_product_mapping(profile, categories, existing), "t")


def test_products_keep_all_codes_on_a_second_run(values, categories):
    """New products and a category sorting before all old ones must not move anything."""
    first = build(values, categories, None, product("000012-00002", "stones"), product("000013-00003", " Rings "))
    second = build(
        values, categories, first,
        product("000001-00001", "AXES"), product("000012-00002", "STONES"), product("000012-00009", "STONES", "a"),
    )
    old, new = ({r.full_sku_code: r for r in df.collect()} for df in (first, second))
    assert all(new[sku] == row for sku, row in old.items())
    assert old["000013-00003"].pseudo_full_sku_code == "SKU-SR-000001"
    assert old["000012-00002"].pseudo_full_sku_code == "SKU-SR2-000001"
    assert new["000001-00001"].pseudo_full_sku_code == "SKU-SR3-000001"
    assert new["000012-00009"].pseudo_full_sku_code == "SKU-SR2-000002"
    assert new["000012-00009"].pseudo_product_description == "Standard Rock Product SR-002"
    assert new["000012-00009"].pseudo_first_half_sku_code == old["000012-00002"].pseudo_first_half_sku_code
    assert len({r.pseudo_full_sku_code for r in new.values()}) == len(new) == 4


def test_unmapped_category_and_double_category_fail(values, categories):
    with pytest.raises(Exception, match="Unmapped category"):
        build(values, categories, None, product("000012-00002", "toys"))
    doubled = categories.unionByName(values("product_category pseudo_category", (" rings", "Other")))
    with pytest.raises(GuardError, match="duplicate"):
        build(values, doubled, None, product("000012-00002", "rings"))


def test_prefixes_of_bases_that_end_in_digits(values):
    """'P 2' has the initials P2, the second taker of P: the later one gets the next free name."""
    df = values("pseudo_category pseudo_full_sku_code", ("P 2", None), ("Pa", None), ("Pb", None), ("Pc", "SKU-P3-000004"))
    assert dict(rows(identities.category_prefixes(df), "*")) == {"P 2": "P2", "Pa": "P", "Pb": "P4", "Pc": "P3"}
    torn = values("pseudo_category pseudo_full_sku_code", ("A", "SKU-A-000001"), ("A", "SKU-B-000001"))
    with pytest.raises(Exception, match="Corrupt SKU prefixes"):
        identities.category_prefixes(torn).collect()


def greedy_prefixes(rows):
    """The rule itself: categories in order, each taking the first name nobody has."""
    found = {c: p for c, p in rows if p}
    for category in sorted(c for c, p in rows if not p):
        base = "".join(w[0] for w in category.split()).upper()
        names = (base if k == 1 else f"{base}{k}" for k in itertools.count(1))
        found[category] = next(n for n in names if n not in found.values())
    return found


@pytest.mark.parametrize("seed", range(3))
def test_prefixes_equal_the_rule(values, seed):
    rnd = random.Random(seed)
    words = ["pa", "pb", "pc", "2", "22", "3", "1", "0x", "q"]
    waiting = {" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for _ in range(60)}
    kept = {f"kept {k}": p for k, p in enumerate(rnd.sample(["P", "P2", "P3", "P5", "P22", "P02", "P1", "Q7", "Q", "PP2", "Z9"], 6))}
    rows_in = [(c, None) for c in waiting] + list(kept.items())
    df = values("pseudo_category pseudo_full_sku_code", *((c, p and f"SKU-{p}-000001") for c, p in rows_in))
    assert dict(rows(identities.category_prefixes(df), "*")) == greedy_prefixes(rows_in)


def test_many_categories_share_their_initials(spark):
    """More than one piece of numbers, every third of them held by an assigned prefix."""
    made = spark.range(12_000).selectExpr(
        "format_string('%s %05d', if(id % 3 = 0, 'Kept', 'A'), id) as pseudo_category",
        "if(id % 3 = 0, concat('SKU-AN', id + 1, '-000001'), null) as pseudo_full_sku_code",
    ).selectExpr("replace(pseudo_category, ' ', ' n') as pseudo_category", "pseudo_full_sku_code")
    got = identities.category_prefixes(made).where("pseudo_category like 'A %'").collect()
    free = (n for n in itertools.count(1) if not (n > 1 and n < 12_000 and (n - 1) % 3 == 0))
    expected = ["AN" if n == 1 else f"AN{n}" for n in itertools.islice(free, 8_000)]
    assert [r.prefix for r in sorted(got)] == expected


def test_keep_first_follows_file_order(values):
    df = values(
        f"{PRODUCT} source_filename source_file_row_number",
        (*product("000001-00001", "late"), "b", "1"), (*product("000001-00001", "early"), "a", "9"),
    )
    assert identities.product_profile(df).first().product_category == "early"
    with pytest.raises(Exception, match="Null critical"):
        identities.product_profile(df.withColumn("product_category", F.lit(None).cast("string"))).collect()


def test_backfills_continue_the_unknown_category(values, categories):
    mapping = build(values, categories, None, product("000012-00002", "rings"))
    opened = values("full_sku_code first_half_sku_code unique_sku_code product_description",
                    ("000012-00005", "000012", "00005", "x"), ("000002-00002", "000002", "00002", "y"))
    one = materialize(identities.backfill_products(opened, mapping), "t")
    stock = values("raw_sku product_description source_filename source_file_row_number",
                   ("100001.0", "z", "f", "1"), ("1200005", "x", "f", "2"))
    fresh = identities.inventory_products(stock, one)
    two = {r.full_sku_code: r for r in identities.backfill_products(fresh, one).collect()}
    assert two["000002-00002"].pseudo_full_sku_code == "SKU-UC-000001"
    assert two["000002-00002"].pseudo_unique_sku_code == two["000012-00002"].pseudo_unique_sku_code
    assert two["000012-00005"].pseudo_product_description == "Unknown Category Product UC-002"
    assert two["000001-00001"].pseudo_full_sku_code == "SKU-UC-000003"
    assert two["000001-00001"].pseudo_first_half_sku_code == "SKU-GRP-00003"
    assert len(two) == 4


def test_unknown_prefix_avoids_a_taken_one(values):
    taken = values("pseudo_category pseudo_full_sku_code", ("Upper Class", "SKU-UC-000001"), ("X", "SKU-UC2-000001"))
    assert identities.unknown_prefix(taken).first()[0] == "UC3"
    torn = values("pseudo_category pseudo_full_sku_code", ("Unknown Category", "broken"))
    with pytest.raises(Exception, match="Unknown category"):
        identities.unknown_prefix(torn).collect()


CUSTOMERS = "customer_hash_key source_customer_code ship_to_customer_code customer_name pseudo_customer_name"
GOOD_CUSTOMER = ("k1", "1", "1", "n", "Customer CUST-000001")
GOOD_PRODUCT = ("a", "g", "u", "d", "c", "Cat", "Cat Product C-001", "SKU-C-000001", "SKU-GRP-00001", "SKU-BASE-00001")


@pytest.mark.parametrize(
    "customers, products, expected",
    [
        ([GOOD_CUSTOMER], [GOOD_PRODUCT], set()),
        # several products may share a group
        ([GOOD_CUSTOMER], [GOOD_PRODUCT, ("b", "g", "v", "d", "c", "Cat", "Cat Product C-002", "SKU-C-000002", "SKU-GRP-00001", "SKU-BASE-00002")], set()),
        ([GOOD_CUSTOMER, ("k1", "1", "1", "n", "Customer CUST-000002")], [GOOD_PRODUCT],
         {("repeated_key", "customer_hash_key"), ("split_identity", "customer_hash_key")}),
        ([GOOD_CUSTOMER, ("k2", "1", "1", "n", "Customer CUST-000001")], [GOOD_PRODUCT],
         {("identity_collision", "pseudo_customer_name")}),
        ([("k1", "1", "1", "n", None)], [GOOD_PRODUCT],
         {("null_value", "pseudo_customer_name"), ("unlike_pseudonym", "pseudo_customer_name")}),
        ([("k1", "1", "1", "n", "Acme")], [GOOD_PRODUCT], {("unlike_pseudonym", "pseudo_customer_name")}),
        ([GOOD_CUSTOMER], [GOOD_PRODUCT, ("b", "g", "v", "d", "c", "Cat", "Cat Product C-002", "SKU-C-000002", "SKU-GRP-00009", "SKU-BASE-00002")],
         {("split_identity", "first_half_sku_code")}),
        ([GOOD_CUSTOMER], [GOOD_PRODUCT, ("b", "h", "v", "d", "c", "Cat", "d", "SKU-C-000001", "SKU-GRP-00002", "SKU-BASE-00002")],
         {("identity_collision", "pseudo_full_sku_code"), ("unlike_pseudonym", "pseudo_product_description")}),
    ],
)
def test_mapping_rules(values, customers, products, expected):
    found = identities.violations(
        values(CUSTOMERS, *customers), values(" ".join(PRODUCT_MAPPING_SCHEMA.names), *products)
    )
    assert rows(found, "rule", "column_name") == expected


def test_mapping_without_a_column_fails(values):
    with pytest.raises(GuardError, match="missing"):
        identities.violations(values("customer_hash_key", ("k",)), values("full_sku_code", ("a",)))


def test_repeats_count_null_keys_as_equal(values):
    df = values("k f n", ("a", "x", "1"), ("a", "x", "2"), (None, "x", "3"), (None, "y", "1"), ("b", "x", "4"))
    assert rows(repeated_rows(df, ["k"]), "*") == {
        ("a", "x", "1", 2), ("a", "x", "2", 2), (None, "x", "3", 2), (None, "y", "1", 2),
    }
    assert rows(line_sequence(df, ["k"], ["f", "n"]), "k", "n", "line_sequence") == {
        ("a", "1", 1), ("a", "2", 2), (None, "3", 1), (None, "1", 2), ("b", "4", 1),
    }


def test_mapping_rules_take_two_exchanges(values):
    plan = identities.violations(values(CUSTOMERS, GOOD_CUSTOMER), values(" ".join(PRODUCT_MAPPING_SCHEMA.names), GOOD_PRODUCT))
    text = plan._jdf.queryExecution().sparkPlan().toString()
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in physical and "Join" not in text
