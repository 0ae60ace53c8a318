"""What is monitored: KPIs, entity levels, window lengths and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

RISING, FALLING = "rising", "falling"


@dataclass(frozen=True)
class Kpi:
    """One KPI. ``bad`` says which direction is a degradation.

    A KPI that both vendors report under the same counter is ``shared``: it has one column instead of an
    ``old_``/``new_`` pair. A ``quiet`` KPI is scored, but never raises an alert.
    """

    name: str
    bad: str
    shared: bool = False
    quiet: bool = False

    @property
    def old(self) -> str:
        return self.name if self.shared else f"old_{self.name}"

    @property
    def new(self) -> str:
        return self.name if self.shared else f"new_{self.name}"

    @property
    def avg(self) -> str:
        return f"{self.name}_avg"

    @property
    def std(self) -> str:
        return f"{self.name}_std"

    @property
    def change_rate(self) -> str:
        return f"{self.name}_change_rate"

    @property
    def alert(self) -> str:
        return f"{self.name}_alert"


@dataclass(frozen=True)
class Level:
    """Depth in the entity hierarchy. The first id is always the tower, on which events are detected."""

    name: str
    ids: tuple[str, ...]

    @property
    def tower(self) -> str:
        return self.ids[0]


TOWER = Level("tower", ("tower",))
SECTOR = Level("sector", ("tower", "sector"))
CARRIER = Level("carrier", ("tower", "sector", "carrier"))

# The KPI names and directions of the published tables.
KPIS = (
    Kpi("sip_dc_rate", RISING, shared=True),
    Kpi("rrc_setup_failure", RISING),
    Kpi("bearer_drop_rate", RISING),
    Kpi("rtp_gap", RISING, shared=True),
    Kpi("avgconnected_users", FALLING, quiet=True),
    Kpi("dl_data_volume", FALLING),
    Kpi("uptp_user_perceived_throughput", FALLING),
)

# Header names of the daily KPI files.
RAW_COLUMNS = {
    "DAY": "day",
    "ENODEB": "tower",
    "EUTRANCELL": "sector",
    "CARRIER": "carrier",
    "MMEPOOL": "mmepool",
    "REGION": "region",
    "MARKET": "market",
    "MARKET_DESC": "market_desc",
    "SITE": "site",
    "FSM_LTE_DataERABDrop%": "old_bearer_drop_rate",
    "FSM_LTE_AvgRRCUsers": "old_avgconnected_users",
    "FSM_LTE_DLRLCMBytes": "old_dl_data_volume",
    "FSM_LTE_DL_BurstTputMbps": "old_uptp_user_perceived_throughput",
    "FSM_LTE_RRCF%": "old_rrc_setup_failure",
    "SEA_DefaultERABDropRate_%": "new_bearer_drop_rate",
    "SEA_AvgRRCconnectedUsers_percell": "new_avgconnected_users",
    "SEA_TotalDLRLCLayerDataVolume_MB": "new_dl_data_volume",
    "SEA_DLUserPerceivedTput_Mbps": "new_uptp_user_perceived_throughput",
    "SEA_RRCSetupFailure_%": "new_rrc_setup_failure",
    "S1U_SIP_SC_CallDrop%": "sip_dc_rate",
    "RTP_Gap_Duration_Ratio_Avg%": "rtp_gap",
}

# Descriptive columns carried along with the KPIs.
CATEGORICAL = ("mmepool", "region", "market", "market_desc", "site")


@dataclass(frozen=True)
class Monitor:
    """Parameters of one monitoring set-up."""

    kpis: tuple[Kpi, ...] = KPIS
    categorical: tuple[str, ...] = CATEGORICAL
    baseline_days: int = 14
    follow_days: int = 14
    min_change: float = 0.1
    sigmas: float = 2.0
    digits: int = 2

    @property
    def names(self) -> list[str]:
        return [k.name for k in self.kpis]

    @property
    def old_columns(self) -> list[str]:
        return [k.old for k in self.kpis if not k.shared]

    @property
    def new_columns(self) -> list[str]:
        return [k.new for k in self.kpis if not k.shared]

    @property
    def shared_columns(self) -> list[str]:
        return [k.name for k in self.kpis if k.shared]

    @property
    def panel_columns(self) -> list[str]:
        return self.old_columns + self.new_columns + self.shared_columns

    @property
    def alerts(self) -> list[str]:
        return [k.alert for k in self.kpis]
