"""Who may see which rows, what changed, and encrypted columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from fleetworks import constants as C

Access = Mapping[str, Sequence[str]]


def visible(df: DataFrame, role: str, access: Access = C.REGIONS_BY_ROLE) -> DataFrame:
    """Rows whose ``region`` the role may read. An unknown role reads nothing; loaders and owners read all."""
    if role in C.UNRESTRICTED_ROLES:
        return df
    allowed = list(access.get(role, ()))
    return df.filter(F.col("region").isin(allowed)) if allowed else df.filter(F.lit(False))


def visible_through_customer(df: DataFrame, customers: DataFrame, role: str,
                             access: Access = C.REGIONS_BY_ROLE) -> DataFrame:
    """Rows of customers the role may read; the region rule lives in one place and cascades by key."""
    if role in C.UNRESTRICTED_ROLES:
        return df
    return df.join(visible(customers, role, access).select("customer_id"), "customer_id", "left_semi")


def secure_view(tables: Mapping[str, DataFrame], role: str, access: Access = C.REGIONS_BY_ROLE) -> dict[str, DataFrame]:
    """The role's view of customers, sites and every customer-keyed table given."""
    customers = tables["customers"]
    view = {"customers": visible(customers, role, access)}
    for name, df in tables.items():
        if name != "customers":
            view[name] = visible_through_customer(df, customers, role, access)
    return view


def audit_diff(before: DataFrame, after: DataFrame, key: Sequence[str], table: str, user: str,
               changed_at: datetime | None = None) -> DataFrame:
    """Inserted, deleted and updated rows between two versions of a table, with both row images as JSON."""
    columns = before.columns
    old = before.select(*[F.col(k).alias(f"_old_{k}") for k in key], F.struct(*columns).alias("_old"))
    new = after.select(*[F.col(k).alias(f"_new_{k}") for k in key], F.struct(*columns).alias("_new"))
    same_key = None
    for k in key:
        match = F.col(f"_old_{k}") == F.col(f"_new_{k}")
        same_key = match if same_key is None else same_key & match
    operation = (
        F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "UPDATE")
    )
    stamp = F.lit(changed_at) if changed_at else F.current_timestamp()
    return (
        old.join(new, same_key, "full_outer").withColumn("operation", operation)
        .filter(F.col("operation").isNotNull())
        .select(*[F.coalesce(f"_old_{k}", f"_new_{k}").alias(k) for k in key],
                F.lit(table).alias("table_name"), "operation", F.lit(user).alias("db_user"),
                stamp.alias("changed_at"),
                F.to_json("_old").alias("old_data"), F.to_json("_new").alias("new_data"))
    )


def _digests(df: DataFrame, part: Column, side: str) -> DataFrame:
    """Count and two hashes of the rows of each part; the order of rows does not matter."""
    row = F.struct(*df.columns)
    return df.groupBy(part.alias("_part")).agg(
        F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64(row)).alias("x"),
                 F.sum(F.shiftright(F.xxhash64(F.lit(side != ""), row), 24).cast("decimal(20,0)")).alias("s")).alias(f"_{side}"))


def changed_parts(before: DataFrame, after: DataFrame, part: Column) -> DataFrame:
    """The parts (``_part``) whose rows are not the same in both versions. Only digests move."""
    both = _digests(before, part, "before").join(_digests(after, part, "after"), "_part", "full_outer")
    return both.filter(~F.col("_before").eqNullSafe(F.col("_after"))).select("_part")


def audit_changed_parts(before: DataFrame, after: DataFrame, key: Sequence[str], table: str, user: str,
                        changed_at: datetime | None = None, parts: int = 4096, width: int | None = None) -> DataFrame:
    """As ``audit_diff``, but rows are only compared, and moved, in parts of the key space whose digests differ.

    A part is a range of ``width`` keys where the table has one whole-numbered key and changes lie close together: then
    unchanged ranges are not even read where the files are ordered by it. Otherwise it is one of ``parts`` hash parts.
    Digests are 128 bits and a count. With more than ``parts`` changed parts all rows are compared.
    """
    part = F.expr(f"`{key[0]}` div {width}") if width else F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(parts))
    changed = sorted(r["_part"] for r in changed_parts(before, after, part).limit(parts + 1).collect() if r["_part"] is not None)
    if len(changed) > parts:
        return audit_diff(before, after, key, table, user, changed_at)
    if width:
        inside = _between(F.col(key[0]), changed, width) | F.col(key[0]).isNull()
    else:
        inside = part.isin(changed)
    return audit_diff(before.filter(inside), after.filter(inside), key, table, user, changed_at)


def _between(key: Column, ranges: Sequence[int], width: int) -> Column:
    """Keys of these ranges, neighbouring ones as one. Whole division cuts towards zero, so range 0 has both signs."""
    runs: list[list[int]] = []
    for n in ranges:
        if runs and runs[-1][1] == n - 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    inside = F.lit(False)
    for first, last in runs:
        low = first * width if first > 0 else (first - 1) * width + 1
        high = (last + 1) * width - 1 if last >= 0 else last * width
        inside = inside | key.between(low, high)
    return inside


def encrypt_column(df: DataFrame, column: str, key: Column, out: str | None = None) -> DataFrame:
    """Replace a text column by its AES-GCM ciphertext. The key comes from the caller's secret store."""
    cipher = F.aes_encrypt(F.col(column).cast("string").cast("binary"), key)
    result = df.withColumn(out or column, cipher)
    return result.drop(column) if out and out != column else result


def decrypt_column(df: DataFrame, column: str, key: Column, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, F.aes_decrypt(F.col(column), key).cast("string"))


def _bound_to(table: str, key: Sequence[str]) -> Column:
    """What a ciphertext is tied to: its table and its row's primary key, each with its length."""
    parts = [F.lit(table), *[F.col(k).cast("string") for k in key]]
    return F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]).cast("binary")


def encrypt_rows(df: DataFrame, column: str, keys: DataFrame, key_id: Column, table: str, key: Sequence[str]) -> DataFrame:
    """Replace a text column by AES-GCM ciphertext under each row's key, and note the key in ``<column>_key``.

    ``keys`` has one row (key_id, secret) per key and is joined in. The ciphertext is tied to the table and the primary
    key ``key``: moved to another row it can't be opened. NULL stays NULL. A row whose key is unknown fails.
    """
    named = keys.select(F.col("key_id").alias(f"{column}_key"), F.col("secret").alias("_secret"))
    sealed = F.aes_encrypt(F.col(column).cast("string").cast("binary"), F.col("_secret"), F.lit("GCM"), F.lit("DEFAULT"),
                           F.lit("").cast("binary"), _bound_to(table, key))
    unknown = F.raise_error(F.concat(F.lit("no key named "), F.coalesce(F.col(f"{column}_key").cast("string"), F.lit("null"))))
    return df.withColumn(f"{column}_key", key_id).join(named, f"{column}_key", "left").withColumn(
        column, F.when(F.col("_secret").isNotNull(), sealed).otherwise(unknown.cast("binary"))).select(*df.columns, f"{column}_key")


def decrypt_rows(df: DataFrame, column: str, keys: DataFrame, table: str, key: Sequence[str], out: str | None = None) -> DataFrame:
    """Open a column under each row's own key, old and new ones side by side.

    What can't be opened (altered, moved from another row or table, or under a key that is not given) becomes NULL.
    """
    named = keys.select(F.col("key_id").alias(f"{column}_key"), F.col("secret").alias("_secret"))
    opened = F.try_aes_decrypt(F.col(column), F.col("_secret"), F.lit("GCM"), F.lit("DEFAULT"), _bound_to(table, key)).cast("string")
    rest = [c for c in df.columns if c != (out or column)]
    return df.join(named, f"{column}_key", "left").withColumn("_opened", opened).select(*rest, F.col("_opened").alias(out or column))


def rotate_key(df: DataFrame, column: str, keys: DataFrame, retired: Sequence, new_key, table: str, key: Sequence[str]) -> DataFrame:
    """Seal the rows under ``retired`` keys anew under ``new_key``; all others stay byte for byte. A row that can't be opened fails."""
    old = F.coalesce(F.col(f"{column}_key").isin(list(retired)), F.lit(False))
    opened = decrypt_rows(df.filter(old), column, keys, table, key, "_plain")
    lost = F.col("_plain").isNull() & F.col(column).isNotNull()
    plain = F.when(lost, F.raise_error(F.lit(f"a row of {table} can't be opened"))).otherwise(F.col("_plain"))
    sealed = encrypt_rows(opened.withColumn(column, plain).drop("_plain", f"{column}_key"), column, keys, F.lit(new_key), table, key)
    return df.filter(~old).unionByName(sealed)
