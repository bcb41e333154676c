"""Column builders."""
from pumpguard.functions.columns import (ait_loss_amount, high_risk_route, is_verified,
                                         millis_between, number_range, safe_rate, to_day,
                                         to_event_time)
from pumpguard.functions import rules

__all__ = ["ait_loss_amount", "high_risk_route", "is_verified", "millis_between",
           "number_range", "safe_rate", "to_day", "to_event_time", "rules"]
