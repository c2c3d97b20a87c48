"""Whole flows: video, bookings, leads, and the reports on the bookings mart."""
