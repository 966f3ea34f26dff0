from loomwright.cli import main

raise SystemExit(main())
