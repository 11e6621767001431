from kpiloom.functions import dates, fixed, numbers, text

__all__ = ["dates", "fixed", "numbers", "text"]
