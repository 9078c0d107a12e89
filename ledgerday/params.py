"""Business parameters, passed to every operator instead of buried literals."""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerday import constants as K


@dataclass(frozen=True)
class Items:
    """Ledger codes the reports test for."""

    coal: str = K.COAL_ITEM
    maize: str = K.MAIZE_ITEM
    ethanol: str = K.ETHANOL_ITEM
    ethanol_label: str = K.ETHANOL_LABEL
    scrap: tuple[str, ...] = K.SCRAP_ITEMS
    production_code: str = K.PRODUCTION_CODE
    sale_code: str = K.SALE_CODE
    return_natures: tuple[str, ...] = K.RETURN_NATURES
    cancelled_party: str = K.CANCELLED_PARTY
    kg_unit: str = K.KG_UNIT
    tonne_unit: str = K.TONNE_UNIT
    kg_per_tonne: int = K.KG_PER_TONNE

    def material_item(self, material: str) -> str:
        return {"coal": self.coal, "maize": self.maize, "ethanol": self.ethanol}[material]


@dataclass(frozen=True)
class Report:
    """One kind of outgoing message and where its recipients come from."""

    kind: str
    report_name: str
    to_flag: str
    subject: str
    # Material whose absence triggers this message; None for the sales report.
    material: str | None = None


DEFAULT_ITEMS = Items()

DEFAULT_REPORTS: tuple[Report, ...] = (
    Report("coal_availability", K.COAL_REPORT, K.COAL_TO_FLAG, K.COAL_SUBJECT, "coal"),
    Report("maize_availability", K.MAIZE_REPORT, K.MAIZE_TO_FLAG, K.MAIZE_SUBJECT, "maize"),
    Report("monthly_report", K.MONTHLY_REPORT, K.MONTHLY_TO_FLAG, K.MONTHLY_SUBJECT, None),
)


@dataclass(frozen=True)
class RunOptions:
    """Options of the daily job (look-back, channels, log retention)."""

    channels: tuple[str, ...] = K.CHANNELS
    max_days_back: int = K.MAX_DAYS_BACK
    retain: int = K.LOG_RETENTION
    date_offset: int = K.DATE_OFFSET
    alert_materials: tuple[str, ...] = ("coal", "maize")
    report_channel: str = "email"
    reports: tuple[Report, ...] = field(default=DEFAULT_REPORTS)
