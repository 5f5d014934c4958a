"""Policy attached to data: column masks, row filters, and the roles that lift them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The roles a policy knows.
COMPLIANCE, ENGINEER = "compliance", "engineer"
LIQUOR_ANALYST, CANNABIS_ANALYST = "liquor_analyst", "cannabis_analyst"


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table by a name from outside; Spark's IDENTIFIER clause refuses all that is not a name."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def setting(spark: SparkSession, value: str | bool) -> bool:
    """A job setting as Spark reads booleans; other text is an error of the cast, a missing value is False."""
    return bool(spark.sql("SELECT cast(:value AS boolean)", args={"value": value}).first()[0])


def mask_email(email: Column) -> Column:
    return F.concat(F.lit("***@"), F.substring_index(email, "@", -1))


def mask_birth_date(day: Column) -> Column:
    return F.concat(F.substring(day, 1, 4), F.lit("-**-**"))


def domain_rows(roles: frozenset[str]) -> Column:
    """Rows of the sales report a set of roles may see; no role, no rows."""
    if roles & {ENGINEER, COMPLIANCE}:
        return F.lit(True)
    seen = [d for d, role in (("liquor", LIQUOR_ANALYST), ("cannabis", CANNABIS_ANALYST)) if role in roles]
    return F.col("domain").isin(*seen) if seen else F.lit(False)


@dataclass(frozen=True)
class Policy:
    """Masks by column, the role that sees through them, and a row filter by roles."""

    masks: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    unmasked_for: str = COMPLIANCE
    rows: Callable[[frozenset[str]], Column] | None = None


PLAYERS = Policy(masks={"email": mask_email, "date_of_birth": mask_birth_date})
RETAIL_SALES = Policy(rows=domain_rows)


def apply_policy(df: DataFrame, policy: Policy, roles: set[str] | frozenset[str] = frozenset(),
                 enforce: bool = True) -> DataFrame:
    """The view of `df` the given roles get. The row filter is a plain predicate on a table
    column, so it reaches the scan."""
    if not enforce:
        return df
    roles = frozenset(roles)
    if policy.rows is not None:
        df = df.filter(policy.rows(roles))
    if policy.unmasked_for in roles:
        return df
    return df.withColumns({c: mask(F.col(c)) for c, mask in policy.masks.items() if c in df.columns})


def register_functions(spark) -> None:
    """The masks and the filter as SQL functions, for views written in SQL."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION mask_email(email STRING, roles ARRAY<STRING>) RETURNS STRING
        RETURN if(array_contains(roles, 'compliance'), email, concat('***@', substring_index(email, '@', -1)))""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION mask_dob(dob STRING, roles ARRAY<STRING>) RETURNS STRING
        RETURN if(array_contains(roles, 'compliance'), dob, concat(substring(dob, 1, 4), '-**-**'))""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION filter_domain(domain STRING, roles ARRAY<STRING>) RETURNS BOOLEAN
        RETURN array_contains(roles, 'engineer') OR array_contains(roles, 'compliance')
            OR (domain = 'liquor' AND array_contains(roles, 'liquor_analyst'))
            OR (domain = 'cannabis' AND array_contains(roles, 'cannabis_analyst'))""")


PII_COLUMNS = ("email", "date_of_birth")  # fixed values


def assert_no_pii(df: DataFrame) -> DataFrame:
    """Gold tables carry none of the personal columns."""
    leaked = [c for c in PII_COLUMNS if c in df.columns]
    if leaked:
        raise ValueError(f"personal columns in a gold table: {leaked}")
    return df
