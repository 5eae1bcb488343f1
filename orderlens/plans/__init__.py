"""The business plans: dataset, features, modelling, scoring and reports."""
