"""One regressor per target on calendar features."""
