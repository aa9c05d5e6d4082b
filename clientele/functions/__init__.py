"""Column functions: money, dates, segment labels, special functions."""
