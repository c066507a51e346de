"""Static configuration: dimension sets, window slots, variants and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Dimension sets of the ad counters; the text is part of every counter key.
AD_DIMENSION_SETS = (
    "c_id",
    "ad_id",
    "ad_package_name",
    "ad_package_category",
    "package_name#c_id",
    "package_name#ad_id",
    "package_name#ad_package_name",
    "package_name#ad_package_category",
    "pos_id#c_id",
    "pos_id#ad_id",
    "pos_id#ad_package_name",
    "pos_id#ad_package_category",
)

# Dimension sets of the user counters.
USER_DIMENSION_SETS = (
    "user_id",
    "user_id#ad_id",
    "user_id#c_id",
    "user_id#ad_package_name",
    "user_id#ad_package_category",
    "user_id#pos_id#ad_id",
    "user_id#pos_id#c_id",
    "user_id#pos_id#ad_package_name",
    "user_id#pos_id#ad_package_category",
)

# Legal window tags; the published slot is "countFeatures" + tag.
WINDOW_TAGS = ("7d", "14d", "30d", "1d", "3d", "Bj1d")
SLOT_PREFIX = "countFeatures"

# Key prefixes and lifetime of published user entries.
USER_COUNTER_KEY_PREFIX = "nt:ads:user_counter:"
USER_PROFILE_KEY_PREFIX = "nt:ads:user_profile:"
ENTRY_TTL_SECONDS = 259_200

# Event names counted as impressions and clicks, and the ad platform they belong to.
EVENT_NAMES = ("AD_CpiShow", "AD_CpiClick")
AD_PLATFORM = "cpi"

MEASURES = ("imp", "click", "attr_install")
INT32_MAX = 2**31 - 1


@dataclass(frozen=True)
class DimSet:
    """One dimension combination, e.g. ``pos_id#ad_id``."""

    name: str

    @property
    def dims(self) -> tuple[str, ...]:
        return tuple(self.name.split("#"))

    @property
    def slot(self) -> str:
        """Field name of the combination in an assembled sample (``posIdAdId``)."""
        head, *tail = self.name.replace("#", "_").split("_")
        return head + "".join(part.capitalize() for part in tail)


def dim_sets(names) -> tuple[DimSet, ...]:
    return tuple(DimSet(n) for n in names)


@dataclass(frozen=True)
class Variant:
    """Switches between the two supported flavours of the data set.

    ``nation_prefix``   ad counters are kept per nation and the nation leads the key;
    ``install_field``   published name of the install measure and of the install label;
    ``ascii_dims_only`` user dimension sets with a non-ASCII value are left out;
    ``behaviour``       profiles carry app lists besides the base attributes.
    """

    name: str
    ad_sets: tuple[DimSet, ...]
    user_sets: tuple[DimSet, ...] = field(default_factory=lambda: dim_sets(USER_DIMENSION_SETS))
    install_field: str = "attrInstall"
    nation_prefix: bool = False
    ascii_dims_only: bool = False
    behaviour: bool = True

    def with_(self, **changes) -> "Variant":
        return replace(self, **changes)


MAIN = Variant("main", dim_sets(AD_DIMENSION_SETS))
NATION = Variant(
    "nation",
    dim_sets(s for s in AD_DIMENSION_SETS if not s.startswith("package_name#")),
    install_field="install",
    nation_prefix=True,
    ascii_dims_only=True,
    behaviour=False,
)


@dataclass(frozen=True)
class SmoothingRules:
    """Thresholds of the day-and-hour merge."""

    category_min_imp: int = 10_000
    name_min_imp: int = 10_000
    name_floor_imp: int = 50
    imps_per_install: int = 10_000
