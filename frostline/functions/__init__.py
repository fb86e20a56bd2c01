from frostline.functions import calendar, values

__all__ = ["calendar", "values"]
