"""Query plans: the activity snapshot and the composed medallion runs."""
