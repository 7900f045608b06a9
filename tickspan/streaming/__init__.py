from .epochs import claim_epoch
from .feed import alert_feed, start_alert_feed
from .jobs import (
    drain,
    final_bars,
    final_wider_bars,
    flush_tick,
    print_messages,
    start_bars,
    start_final_bars,
    start_quarantine,
)
from .previous import priced_bars, start_priced_bars
from .stateful import with_previous_close
from .tally import Tally, counted, tallied
from .unfinished import open_bars

__all__ = [
    "Tally",
    "alert_feed",
    "claim_epoch",
    "counted",
    "drain",
    "final_bars",
    "final_wider_bars",
    "flush_tick",
    "open_bars",
    "priced_bars",
    "print_messages",
    "start_alert_feed",
    "start_bars",
    "start_final_bars",
    "start_priced_bars",
    "start_quarantine",
    "tallied",
    "with_previous_close",
]
