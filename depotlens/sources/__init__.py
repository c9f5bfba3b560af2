"""Where signals come from and where tables are kept."""
