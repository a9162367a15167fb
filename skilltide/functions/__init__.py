"""Column functions over posting text, dates, links and model output."""
