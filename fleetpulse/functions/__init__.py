from fleetpulse.functions.columns import (
    blank_text, byte_length, clock_text, day_key, epoch_ms, event_time,
    narrow, number_or_zero, round_half_up, text_or_empty, whole_second,
)

__all__ = [
    "blank_text", "byte_length", "clock_text", "day_key", "epoch_ms", "event_time",
    "narrow", "number_or_zero", "round_half_up", "text_or_empty", "whole_second",
]
