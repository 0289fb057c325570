from tickloom.functions.casts import blank_to_null, epoch_ms, instant, is_blank, to_decimal, utc_text

__all__ = ["blank_to_null", "epoch_ms", "instant", "is_blank", "to_decimal", "utc_text"]
