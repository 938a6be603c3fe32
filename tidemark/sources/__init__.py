"""Reading landed pages, staged content and keyed tables; writing keyed tables."""
