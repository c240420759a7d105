"""Where data comes from and goes to: zones, arrivals, the lookup store, star-schema views."""
