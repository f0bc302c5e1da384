"""Column roles of a labelled table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

# Column roles of the connection-record tables the studies run on.
CONNECTION_LABEL = "class"
CONNECTION_CATEGORICAL = (
    "protocol_type",
    "service",
    "flag",
    "land",
    "logged_in",
    "is_host_login",
    "is_guest_login",
)
NORMAL = "normal"
ATTACK = "attack"


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are categories, which one is the label, which never become features.

    Every column not named here is a numeric feature.
    """

    categorical: tuple[str, ...] = ()
    label: str = CONNECTION_LABEL
    excluded: tuple[str, ...] = ()

    def numeric(self, columns: Iterable[str]) -> list[str]:
        """The numeric features among ``columns``, in table order."""
        taken = {*self.categorical, *self.excluded, self.label}
        return [c for c in columns if c not in taken]

    def features(self, columns: Iterable[str]) -> list[str]:
        """All feature columns in table order, as a ``label ~ .`` formula sees them."""
        dropped = {*self.excluded, self.label}
        return [c for c in columns if c not in dropped]

    def without(self, columns: Sequence[str]) -> FeatureSpec:
        """The same roles with ``columns`` kept out of the features."""
        return replace(
            self,
            categorical=tuple(c for c in self.categorical if c not in set(columns)),
            excluded=tuple(dict.fromkeys((*self.excluded, *columns))),
        )


def connection_spec(*, key: Sequence[str] = (), host_login: bool = False) -> FeatureSpec:
    """Roles for connection records; only the clustering study uses ``is_host_login``."""
    spec = FeatureSpec(categorical=CONNECTION_CATEGORICAL, excluded=tuple(key))
    return spec if host_login else spec.without(["is_host_login"])
