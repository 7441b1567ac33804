"""Writers: error output, feed parts and the target table."""
