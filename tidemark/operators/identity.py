"""Identity across systems and firmographic enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.values import normal_email
from tidemark.operators.components import components_of_keys
from tidemark.operators.product import events_between
from tidemark.operators.relational import latest_by_key
from tidemark.operators.skew import spread_join

SYSTEMS = ("crm", "billing", "marketing", "product")
# Mail domains that many companies share, so that they say nothing about a company.
SHARED_DOMAINS = ("aol.com", "gmail.com", "gmx.com", "hotmail.com", "icloud.com", "live.com", "mail.com", "msn.com",
                  "outlook.com", "proton.me", "protonmail.com", "qq.com", "yahoo.com", "yandex.com", "zoho.com")


def identity_links(accounts: DataFrame, customers: DataFrame, contacts: DataFrame, events: DataFrame,
                   start: date | str, end: date | str) -> DataFrame:
    """Distinct (account_id, system, external_id) of the four systems; events of ``[start, end]`` only.

    Billing links by the account id in its metadata, marketing by the normalised email of the
    newest customer with it, product by the account id of its events.  Every link is
    many-to-one, so no group is ever paired with itself; contacts that share one e-mail are
    spread.
    """
    known = accounts.select("account_id")
    crm = known.select("account_id", F.lit("crm").alias("system"), F.col("account_id").alias("external_id"))
    billed = (customers.select(F.col("salesforce_account_id").alias("account_id"), "customer_id",
                               normal_email(F.col("email")).alias("email"), "created_at")
              .join(known, "account_id", "left_semi"))
    billing = billed.select("account_id", F.lit("billing").alias("system"), F.col("customer_id").alias("external_id"))
    owner = latest_by_key(billed.filter(F.col("email").isNotNull()), ["email"],
                          ["created_at", "customer_id"]).select("email", "account_id")
    reachable = contacts.select(normal_email(F.col("email")).alias("email"), "contact_id").filter(
        F.col("email").isNotNull())
    marketing = (spread_join(reachable, owner, "email", spread_by=["contact_id"])
                 .select("account_id", F.lit("marketing").alias("system"), F.col("contact_id").alias("external_id")))
    users = (events_between(events, start, end).filter(F.col("account_id").isNotNull() & F.col("user_id").isNotNull())
             .select("account_id", "user_id").distinct().join(known, "account_id", "left_semi"))
    product = users.select("account_id", F.lit("product").alias("system"), F.col("user_id").alias("external_id"))
    return crm.unionByName(billing).unionByName(marketing).unionByName(product).distinct()


def identity_spine(links: DataFrame) -> DataFrame:
    """One row per account: how many ids each system holds, and the first of them.

    The links carry all ids; arrays of them would have no bound.
    """
    columns = []
    for s in SYSTEMS:
        own = F.col("system") == s
        columns += [F.count(F.when(own, 1)).alias(f"{s}_ids"),
                    F.min(F.when(own, F.col("external_id"))).alias(f"{s}_id")]
    return links.groupBy("account_id").agg(*columns)


def email_domain(email: Column) -> Column:
    """What follows the last ``@`` of a normalised e-mail; null where there is none or nothing on either side of it."""
    clean = normal_email(email)
    return F.nullif(F.regexp_extract(clean, r"^[^\s]+@([^\s@]+)$", 1), F.lit(""))


def identity_records(accounts: DataFrame, customers: DataFrame, contacts: DataFrame, events: DataFrame,
                     start: date | str, end: date | str) -> DataFrame:
    """``system, external_id, email, account_id``: every record that the four systems hold, with what it can be matched by.

    Accounts and users carry an account id, customers an account id and an e-mail, contacts an e-mail.  One row per
    record and pair of these; events of ``[start, end]`` only.
    """
    none = F.lit(None).cast("string")

    def of(df, system, external_id, email, account_id):
        return df.select(F.lit(system).alias("system"), F.col(external_id).alias("external_id"), email.alias("email"),
                         account_id.alias("account_id"))

    users = events_between(events, start, end).filter("user_id is not null").select("account_id", "user_id").distinct()
    return (of(accounts, "crm", "account_id", none, F.col("account_id"))
            .unionByName(of(customers, "billing", "customer_id", F.col("email"), F.col("salesforce_account_id")))
            .unionByName(of(contacts, "marketing", "contact_id", F.col("email"), none))
            .unionByName(of(users, "product", "user_id", none, F.col("account_id"))))


def identity_components(records: DataFrame, shared_domains: Sequence[str] | DataFrame = SHARED_DOMAINS,
                        by_domain: bool = True) -> DataFrame:
    """``system, external_id, identity_id``: records that an account id, an e-mail or a company domain link, over any number of
    steps; ``identity_id`` is the least of ``system:external_id`` among them.

    E-mails match after trimming and lower-casing.  ``shared_domains`` (a list, or a frame with a column ``domain``) link
    nobody; their e-mails still do.  A record without anything to match by stands alone, one without a
    system or id is left out.  A domain of n contacts makes n links, not n squared.
    """
    named = records.filter("system is not null and external_id is not null").select(
        F.concat_ws(":", "system", "external_id").alias("_record"), normal_email(F.col("email")).alias("email"),
        email_domain(F.col("email")).alias("_domain"), "account_id")
    if isinstance(shared_domains, DataFrame):
        known = shared_domains.select(F.lower(F.trim("domain")).alias("_shared")).filter("_shared is not null").distinct()
        named = named.join(known, F.col("_domain") == F.col("_shared"), "left")
        domain = F.when(F.col("_shared").isNull(), F.col("_domain"))
    else:
        listed = [d.strip().lower() for d in shared_domains]
        domain = F.when(~F.col("_domain").isin(*listed), F.col("_domain")) if listed else F.col("_domain")
    # A record may have several keys; none of them leaves one null key, which keeps the record.  An e-mail has one
    # domain: where that links, all who share the e-mail meet at the domain.
    account, email = F.concat(F.lit("account:"), F.col("account_id")), F.concat(F.lit("email:"), F.nullif("email", F.lit("")))
    keys = [account, F.coalesce(F.concat(F.lit("domain:"), domain), email) if by_domain else email]
    members = named.select("_record", F.explode_outer(F.array_compact(F.array(*keys))).alias("_key"))
    found = components_of_keys(members, "_record", "_key")
    system = F.substring_index("_record", ":", 1)
    return found.select(system.alias("system"), F.expr("substring(_record, length(substring_index(_record, ':', 1)) + 2)").alias(
        "external_id"), F.col("component").alias("identity_id"))


def identity_sizes(components: DataFrame) -> DataFrame:
    """One row per identity: how many records of each system it has, and whether more than one CRM account meet in it."""
    counts = [F.count(F.when(F.col("system") == s, 1)).alias(f"{s}_ids") for s in SYSTEMS]
    return components.groupBy("identity_id").agg(*counts, (F.count(F.when(F.col("system") == "crm", 1)) > 1).alias("several_accounts"))


def enrich_accounts(accounts: DataFrame, firmographics: DataFrame) -> DataFrame:
    """Accounts found in the firmographics table, with the nested industry code and the stack.

    ``firmographics`` has account_id, employee_count_band, industry (a struct with ``code``)
    and technologies (an array, null when unknown).
    """
    return accounts.select("account_id").join(firmographics, "account_id", "inner").select(
        "account_id", "employee_count_band", F.col("industry.code").alias("industry_code"),
        F.coalesce("technologies", F.array().cast("array<string>")).alias("tech_stack"))
