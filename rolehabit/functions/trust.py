"""Who may use a role, read off the first statement of its trust policy.

The principal is JSON text because its values are a text or a list of texts;
it is parsed once into a VARIANT and probed there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolehabit.settings import (
    CROSS_ACCOUNT_MESSAGE,
    FEDERATED_MESSAGE,
    SERVICE_MESSAGE,
    Settings,
)

KINDS = ("Service", "Federated", "AWS")  # first present wins


def first_principal(policy: Column) -> Column:
    """NULL where the policy has no statement list or its first has no principal.

    A bare ``"*"`` stays valid JSON.
    """
    found = F.try_variant_get(
        F.try_parse_json(policy), "$.Statement[0].Principal", "variant"
    )
    return F.nullif(F.to_json(found), F.lit("null"))


def classify(roles: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``association_type``, ``associated_with`` (VARIANT), ``association_message``
    and ``base_severity`` from ``principal_json`` and ``role_doc``."""
    probed = roles.withColumn("_principal", F.try_parse_json("principal_json")).withColumns(
        {kind: F.try_variant_get("_principal", f"$.{kind}", "variant") for kind in KINDS}
    )
    federated = F.col("Federated")
    listed = F.try_variant_get(federated, "$", "array<string>")
    # a list must hold the token as an element, a text only contain it
    trusted = F.lit(False)
    if settings.idp_token is not None:
        trusted = F.when(
            listed.isNotNull(), F.array_contains(listed, settings.idp_token)
        ).otherwise(federated.cast("string").contains(settings.idp_token))

    def by_kind(service: Column, federated: Column, aws: Column, other: Column) -> Column:
        return (
            F.when(F.col("Service").isNotNull(), service)
            .when(F.col("Federated").isNotNull(), federated)
            .when(F.col("AWS").isNotNull(), aws)
            .otherwise(other)
        )

    return probed.withColumns(
        {
            "association_type": by_kind(*[F.lit(kind) for kind in (*KINDS, "?")]),
            "associated_with": F.coalesce(*KINDS, F.parse_json(F.lit('"?"'))),
            "association_message": by_kind(
                F.concat(F.lit(SERVICE_MESSAGE), F.col("Service").cast("string")),
                F.lit(FEDERATED_MESSAGE),
                F.lit(CROSS_ACCOUNT_MESSAGE),
                F.col("role_doc"),
            ),
            "base_severity": by_kind(
                F.lit("High"),
                F.when(trusted, "Informational").otherwise("High"),
                F.lit("Medium"),
                F.lit("Informational"),
            ),
        }
    ).drop("_principal", *KINDS)
