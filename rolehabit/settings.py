"""Options of a run, and the fixed values every run shares."""

from __future__ import annotations

from dataclasses import dataclass

HOUR = 3600
DAY = 24 * HOUR

# ---------------------------------------------------------------------------
# Texts and lists that consumers of the alerts already rely on.
# ---------------------------------------------------------------------------
ALERT_NAME = "CloudTrailAnomaly"
ALERT_NOTE = (
    "Activity has been detected that is not within the past 90 days "
    "baseline activity for this role and account."
)
ALERT_SOURCETYPE = "lambda:cloudtrailanomaly"
ERROR_SOURCETYPE = "lambda:cloudtrailanomaly:error"

SERVICE_MESSAGE = (
    "AWS services can be associated with this role. The following service(s) "
    "can be associated with this particular role: "
)
FEDERATED_MESSAGE = (
    "Federated users can use this role. This means that users must first "
    "authenticate outside of aws."
)
CROSS_ACCOUNT_MESSAGE = (
    "This is a role from another account. Someone or thing requested temporary "
    "access keys to this account and made API calls."
)

SERVICE_LINKED_SEGMENT = "aws-service-role"

ROLE_BRANCH, ROOT_BRANCH, USER_BRANCH = "AssumedRole", "Root", "IAMUser"
IDENTITY_TYPES = (ROLE_BRANCH, ROOT_BRANCH, USER_BRANCH)

REGIONS = (
    "ap-northeast-1",
    "ap-northeast-2",
    "ap-northeast-3",
    "ap-south-1",
    "ap-south-2",
    "ap-southeast-1",
    "ap-southeast-2",
    "ca-central-1",
    "ca-central-2",
    "eu-central-1",
    "eu-central-2",
    "eu-north-1",
    "eu-west-1",
    "eu-west-2",
    "eu-west-3",
    "sa-east-1",
    "us-east-1",
    "us-east-2",
    "us-west-1",
    "us-west-2",
)


@dataclass(frozen=True)
class Settings:
    """What may differ between deployments.  Durations are in seconds."""

    ttl: int = 90 * DAY
    """How long an action stays known after it was last seen (inclusive)."""

    window: int = HOUR
    """How far back from the run time a tick looks."""

    role_grace: int = 15 * DAY
    """Roles younger than this are learned but not reported."""

    downgrade_below: int = 5
    """Fewer new actions than this make an alert Informational."""

    idp_token: str | None = None
    """Marks the trusted identity provider in a federated principal; none is trusted without it."""

    ignored_roles: tuple[str, ...] = ()
    ignored_actions: tuple[str, ...] = ()
    ignored_services: tuple[str, ...] = ()
    skipped_accounts: tuple[str, ...] = ()

    business_token: str | None = None
    """Keep only accounts whose lower-cased name contains this text."""

    regions: tuple[str, ...] = ()
    """Allow-list of regions; empty means all (``REGIONS`` is the usual list)."""

    bound_above: bool = True
    """Drop events at or after the run time, so that a tick cannot see ahead."""

    today_only: bool = False
    """Look only at the run's own date, losing the part before midnight."""

    owner_as_list: bool = False
    """Emit ``account_owner`` as a one-element list instead of a text."""

    topic: bool = False
    """Wrap alerts and errors as messages of a topic."""

    index: str = "main"
    """Destination index named in the envelope."""

    def __post_init__(self):
        if self.idp_token == "":
            raise ValueError("an empty identity provider token would trust every text")
