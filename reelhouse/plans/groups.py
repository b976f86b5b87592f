"""Facts by client group: namesakes are kept beside the fact instead of multiplying it.

A client reference leads to one group, the clients of one store that it can't tell apart (all with its name at the store that states
no birth date). The fact has one row per event and product; ``pont_groupe_client`` has the clients of a group. Totals weigh a row
by the size of its group, distinct clients add the sizes of distinct groups, since a client is in one group; only a question about
clients themselves expands the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.functions.dates import parse_birth_date
from reelhouse.functions.text import strip_one_prefix
from reelhouse.operators.dedup import dense_keys
from reelhouse.operators.shape import union_all

NAME_ONLY = 2  # the store whose sales name their client without a birth date


def _group_text(first: Column, last: Column, born: Column | None) -> Column:
    """What a reference says of its client; NULL when a part is missing, so that it leads nowhere."""
    parts = [F.lower(first), F.lower(last), *([] if born is None else [born.cast("string")])]
    text = parts[0]
    for part in parts[1:]:
        text = F.concat(text, F.lit("|"), part)
    return text


def _with_group_text(clients: DataFrame) -> DataFrame:
    name = _group_text(F.col("prenom"), F.col("nom"), None)
    person = _group_text(F.col("prenom"), F.col("nom"), F.col("date_naissance"))
    return clients.select("client_id", "magasin_id", F.when(F.col("magasin_id") == NAME_ONLY, name).otherwise(person).alias("cle")).where("cle IS NOT NULL")


def client_groups(clients: DataFrame) -> DataFrame:
    """(groupe_id, magasin_id, cle, nb_clients), one row per group."""
    sizes = _with_group_text(clients).groupBy("magasin_id", "cle").agg(F.count(F.lit(1)).alias("nb_clients"))
    return dense_keys(sizes, ["magasin_id", "cle"], "groupe_id")


def group_members(clients: DataFrame, groups: DataFrame) -> DataFrame:
    """(groupe_id, client_id), one row per client with a group."""
    return _with_group_text(clients).join(groups.select("groupe_id", "magasin_id", "cle"), ["magasin_id", "cle"]).select("groupe_id", "client_id")


def group_refs(src, groups: DataFrame) -> DataFrame:
    """(magasin_id, client_ref, groupe_id), one row per reference that leads to a group."""
    stripped = lambda name: strip_one_prefix(F.col(name))
    bb = src.bb_customer.select(F.lit(1).alias("magasin_id"), F.col("code").alias("client_ref"),
                                _group_text(stripped("firstname"), stripped("lastname"), parse_birth_date(F.col("dob"))).alias("cle"))
    ms = src.ms_customer.select(F.lit(2).alias("magasin_id"), F.col("code").cast("string").alias("client_ref"),
                                _group_text(stripped("name"), stripped("surname"), None).alias("cle"))
    known = groups.select("groupe_id", "magasin_id", "cle")
    named = union_all(bb, ms).join(known, ["magasin_id", "cle"]).select("magasin_id", "client_ref", "groupe_id")
    rebuilt = known.where("magasin_id = 3").select("magasin_id", F.col("cle").alias("client_ref"), "groupe_id")
    return named.unionByName(rebuilt)


def expanded(fact: DataFrame, members: DataFrame) -> DataFrame:
    """The fact with one row per client of each row's group."""
    return fact.join(members, "groupe_id").drop("groupe_id")


def totals(fact: DataFrame, groups: DataFrame, dates: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Sums ``{name: column}`` and distinct clients (nb_clients) per ``keys``, as the expanded fact gives them, without expanding it.

    Rows are summed per group first; a group's sums count once per client in it.
    """
    months = F.broadcast(dates.select("temps_id", "annee", "trimestre", "mois"))  # one row per day
    per_group = fact.drop("annee").join(months, "temps_id").groupBy(*keys, "groupe_id").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    sized = per_group.join(groups.select("groupe_id", "nb_clients"), "groupe_id")
    return sized.groupBy(*keys).agg(
        *[F.sum(F.col(name) * F.col("nb_clients")).cast(dict(per_group.dtypes)[name]).alias(name) for name in sums], F.sum("nb_clients").alias("nb_clients"))
