"""Client and account masters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions import bands
from coffer.operators.joins import left_join_known, referrers


def decode_client(clients: DataFrame) -> DataFrame:
    """Client codes as labels."""
    return clients.select(
        "client_id",
        F.trim(F.replace("client_name", F.lit("null"), F.lit(""))).alias("client_name"),
        bands.decode("status_code", bands.CLIENT_STATUS).alias("client_status"),
        bands.decode("gender_code", bands.CLIENT_GENDER).alias("client_gender"),
        bands.decode("type_code", bands.CLIENT_TYPE).alias("client_type"),
        bands.decode("marital_code", bands.MARITAL_STATUS).alias("marital_status"),
        bands.decode("level_code", bands.CLIENT_TIER).alias("client_tier"),
    )


def with_membership(df: DataFrame, key: str, members: DataFrame, flag: str) -> DataFrame:
    """Boolean flag: is the key in ``members``? The member keys are made distinct first, so rows are not repeated."""
    keys = members.select(F.col(members.columns[0]).alias(key)).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def first_match(flags: Mapping[str, str] | Sequence[tuple[str, str]], default: str):
    """Label of the first true flag, as a column."""
    pairs = list(flags.items()) if isinstance(flags, Mapping) else list(flags)
    chain = None
    for flag, label in pairs:
        chain = F.when(F.col(flag), label) if chain is None else chain.when(F.col(flag), label)
    return chain.otherwise(default)


def client_category(clients: DataFrame, wallet_clients: DataFrame, corporate_clients: DataFrame) -> DataFrame:
    """Retail (has an app image) before wallet before corporate before unclassified."""
    flagged = with_membership(clients, "client_id", wallet_clients, "is_wallet")
    flagged = with_membership(flagged, "client_id", corporate_clients, "is_corporate")
    flagged = flagged.withColumn("is_app", F.col("image_id").isNotNull())
    label = first_match(
        [("is_app", "Retail client"), ("is_wallet", "Wallet client"), ("is_corporate", "Corporate client")],
        "Unclassified",
    )
    return flagged.select(
        "client_id",
        F.coalesce("image_id", F.lit(0)).alias("image_id"),
        F.col("is_app").cast("int").alias("is_appclient"),
        F.col("is_wallet").cast("int").alias("is_walletclient"),
        F.col("is_corporate").cast("int").alias("is_corpclient"),
        label.alias("client_category"),
    )


# Product ids of the account classes.
APP_PRODUCTS = (24, 26, 29, 30, 31, 32, 33)
BANK_PRODUCTS = (24, 26, 29, 30, 31, 32, 33, 36)


def account_type(
    accounts: DataFrame, wallet_accounts: DataFrame, corporate_accounts: DataFrame, app_clients: DataFrame,
    app_products: Sequence[int] = APP_PRODUCTS, bank_products: Sequence[int] = BANK_PRODUCTS,
) -> DataFrame:
    """Account class by membership in key sets and by product; first match wins."""
    flagged = with_membership(accounts, "account_no", wallet_accounts, "in_wallet")
    flagged = with_membership(flagged, "account_no", corporate_accounts, "in_corporate")
    flagged = with_membership(flagged, "client_id", app_clients, "in_app")
    label = (
        F.when(F.col("in_wallet") & F.col("in_corporate"), "wallet-corporate")
        .when(F.col("in_corporate"), "pure-corporate")
        .when(F.col("in_app") & F.col("product_id").isin(*app_products), "standard retail")
        .when(~F.col("product_id").isin(*bank_products), "wallet retail")
        .otherwise("others")
    )
    return flagged.select("account_no", "client_id", "product_id", label.alias("account_type"))


def client_or_group(accounts: DataFrame, clients: DataFrame, groups: DataFrame) -> DataFrame:
    """Owner of each account: the client, or the group where the account has no client."""
    named = left_join_known(accounts, clients.select("client_id", "client_name"), "client_id")
    return left_join_known(named, groups, "group_id").select(
        "account_id",
        "account_no",
        F.coalesce("client_id", "group_id").alias("owner_id"),
        F.coalesce("client_name", "group_name").alias("owner_name"),
    )


def account_master(accounts: DataFrame, products: DataFrame, clients: DataFrame, groups: DataFrame) -> DataFrame:
    """Accounts with owner, product and category. The product list is a lookup of a few dozen rows."""
    owner = client_or_group(accounts, clients, groups).select("account_id", "owner_id", "owner_name")
    category = (
        F.when(F.col("product_id").isin(36, 30), "deposit")
        .when(F.col("product_id") == 26, "current")
        .otherwise("savings")
    )
    return (
        accounts.drop("product_name")
        .join(products, "product_id", "left")
        .join(owner, "account_id")
        .select(
            "account_id", "account_no", "owner_id", "owner_name", "product_id", "product_name",
            category.alias("account_category"),
            F.when(F.col("closedon_date").isNull(), "Active").otherwise("Closed").alias("account_status"),
            F.col("approvedon_date").alias("activation_date"), "closedon_date",
        )
    )


def client_master(
    clients: DataFrame, states: DataFrame, categories: DataFrame, registry: DataFrame
) -> DataFrame:
    """One row per client: labels, state, category, registry number."""
    labels = decode_client(clients)
    rest = clients.select("client_id", "activation_date", "closedon_date", "referred_by_id", "daily_withdraw_limit",
                          "max_transaction_limit", "mobile_number", "state_id")
    one_registry = registry.groupBy("client_id").agg(F.min("registry_no").alias("registry_no"))
    return (
        labels.join(rest, "client_id")
        .join(states, "state_id", "left")
        .join(categories.select("client_id", "client_category"), "client_id", "left")
        .join(one_registry, "client_id", "left")
        .drop("state_id")
    )


def group_clients(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Groups with their linked client, 0 where none."""
    return groups.join(members, "group_id", "left").select(
        "group_id", "group_name", F.coalesce("client_id", F.lit(0)).alias("linked_client_id")
    )


def onboarding(
    applications: DataFrame, clients: DataFrame, risk: DataFrame
) -> DataFrame:
    """Business applications with client, risk band and referrer name."""
    known = left_join_known(applications, clients.select("client_id", "client_name", "client_tier", "referred_by_id"), "client_id")
    rated = left_join_known(known, risk, "client_id")
    return left_join_known(rated, referrers(clients, "referrer_name"), "referred_by_id").select(
        "application_id", "client_id", "client_name", "client_tier", "created_on",
        "risk_score", bands.risk_band(F.col("risk_score")).alias("risk_rating"), "referrer_name",
    )
