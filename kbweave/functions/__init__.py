"""Column functions: text, keywords, URLs, dates, HTML heads and rule-based classifiers."""
